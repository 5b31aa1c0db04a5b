"""Lookup tables of fixed size that Spark builds and attaches as scalar subqueries.

A table is one row with one array, written to the shared folder: no part of it passes
through the plan's text, and a stage gets it once. Its size is fixed by a parameter,
whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import written


def dense_array(entries: DataFrame, size: int, kind: str) -> Column:
    """``entries`` (at, value; at most one row a place) as an array of ``size`` values, 0 where there is none.

    Select it in a step of its own, right above a generator or a scan and right below its
    one use: the optimizer then puts the subquery where it is used, and no row carries the array.
    """
    places = entries.sparkSession.range(size).select(F.col("id").alias("at"))
    filled = places.join(entries, "at", "left").select("at", F.coalesce("value", F.lit(0)).cast(kind).alias("value"))
    whole = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("value"))
    return written(whole, "lookup").scalar()


def screen(keys: DataFrame, column: str, size: int = 1 << 22) -> Callable[[Column], Column]:
    """A test that holds for every (long) value of ``column`` in ``keys`` and few others: one bit per value modulo ``size``.

    Where the table is full it screens less, so an exact join has to follow.
    """
    place = F.pmod(F.col(column), F.lit(size))
    words = keys.select((place / 64).cast("long").alias("at"), (place % 64).cast("int").alias("b")).groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, b)")).alias("value"))
    table = dense_array(words, size // 64, "bigint")

    def holds(value: Column) -> Column:
        at = F.pmod(value, F.lit(size))
        return F.getbit(F.get(table, (at / 64).cast("int")), (at % 64).cast("int")) == 1

    return holds
