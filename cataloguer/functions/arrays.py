"""Array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, arr: Column, keep: list, value: str, pos: str | None = None) -> DataFrame:
    """One row per element of ``arr`` (rows with a NULL or empty array give none).

    Same rows as ``posexplode``, but written as ``posexplode_outer`` + a filter on
    the position: for a plain ``explode`` the optimizer infers a ``size(arr) > 0``
    pre-filter and pushes it down, so the expression that builds the array (a
    JSON parse, a regex over a whole text) would be evaluated twice, and below an
    exchange it may even run before the rows are spread over the tasks.
    """
    p = pos or "_pos"
    out = df.select(*keep, F.posexplode_outer(arr).alias(p, value)).where(F.col(p).isNotNull())
    return out if pos else out.drop(p)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a ``value`` that is worked out once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, keep: list, fields: list[Column]) -> DataFrame:
    """``keep`` and ``fields``, the latter behind a generator.

    The optimizer pushes filters through projections and replaces each reference by
    the whole expression, so a parse used by a filter and five columns runs six
    times. It does not push them through a generator: here ``fields`` run once.
    """
    return df.select(*keep, F.inline_outer(F.array(F.struct(*fields))))
