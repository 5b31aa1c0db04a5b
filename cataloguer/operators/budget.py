"""Byte budget over the work order (H2-H4).

Before each download the harvester compares the bytes already on disk with the
cap: at or above it the file is SKIPPED. Bytes on disk grow only by files that
were actually fetched for the first time, so failed and restricted files add 0
and a second visit of the same path adds 0; the file that crosses the cap is
still taken; once reached the cap stays reached (the total never shrinks).
Restricted files bypass the test. Sources without a cap (``uncapped``) are not
tested but their bytes count.

Because the total is monotone, "admitted" is simply ``initial + bytes of earlier
first successful fetches < cap``. The plan:

1. first successful visit per path: a partial aggregate (``first_arrivals``);
2. those become byte *events*, which hold their place in the work order and their bytes;
3. where ``used_before`` is asked for, one exclusive running sum over visits and events
   (``ordering.with_running_sum``: one shuffle, local window, offsets of the ranges; no
   single-task window, no join back); an event sorts right after the visits with the same
   work-order key;
4. else the event that reaches the cap is looked up (``ordering.position_of_sum``) and
   visits after it are capped: no visit is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from .merge import first_arrivals
from .ordering import comes_after, cut_points, position_of_sum, with_running_sum
from ..session import stored


def byte_events(visits: DataFrame, order: list[str], key: list[str], status: str, restricted: str,
                size: str, on_disk: str | None = None, station: str | None = None) -> DataFrame:
    """First successful visit per path: ``order``, ``key``, ``size`` (and ``station``), all that later steps read."""
    ok = (F.col(status) == rules.SUCCESS) & ~F.coalesce(F.col(restricted), F.lit(False))
    if on_disk:  # its bytes are in ``initial_bytes`` already
        ok = ok & ~F.coalesce(F.col(on_disk), F.lit(False))
    cols = list(dict.fromkeys([*key, *order, size, *([station] if station else [])]))
    return first_arrivals(visits.where(ok).select(*cols), key, order)


def admit_by_budget(visits: DataFrame, order: list[str], key: list[str], cap_bytes: int,
                    initial_bytes: int = 0, status: str = "status", restricted: str = "restricted",
                    size: str = "size_bytes", uncapped: Column | None = None,
                    on_disk: str | None = None, events: DataFrame | None = None, used: bool = True) -> DataFrame:
    """Visits with ``used_before`` (bytes on disk before the visit), ``capped`` and ``budget_status``.

    ``on_disk`` names a flag of visits whose file was there before the run: it is part
    of ``initial_bytes`` and adds nothing. ``events`` (``order`` and ``size``) are the first
    successful visits, where the caller has them. Without ``used`` there is no ``used_before``;
    the visits should be written rows, as they are read several times.
    """
    if events is None:
        ev = byte_events(visits, order, key, status, restricted, size, on_disk).select(*dict.fromkeys([*order, size]))
        ev = ev if used else stored(ev, "byte-events")
    else:
        ev = events.select(*dict.fromkeys([*order, size]))
    ev = ev.withColumn("_bytes", F.coalesce(F.col(size).cast("bigint"), F.lit(0)))
    if not used and ev.where("_bytes < 0").isEmpty():
        last = None if initial_bytes >= cap_bytes else position_of_sum(ev.select(*order, "_bytes"), order, "_bytes", cap_bytes - initial_bytes)
        run = visits
        capped = F.lit(initial_bytes >= cap_bytes) if last is None else comes_after(visits, order, last)
    else:
        u = visits.withColumn("_is_event", F.lit(0)).withColumn("_bytes", F.lit(0).cast("bigint")).unionByName(
            ev.withColumn("_is_event", F.lit(1)), allowMissingColumns=True)
        run = with_running_sum(u, order, F.col("_bytes"), name="_sum", exclusive=True, cuts=cut_points(visits, order), ties=["_is_event"])
        run = run.where(F.col("_is_event") == 0).withColumn("used_before", (F.col("_sum") + F.lit(initial_bytes)))
        capped = F.col("used_before") >= cap_bytes
    if uncapped is not None:
        capped = capped & ~uncapped
    run = run.withColumn("capped", capped)
    capped = F.col("capped")
    out = run.withColumn(
        "budget_status",
        F.when(F.coalesce(F.col(restricted), F.lit(False)), F.lit(rules.RESTRICTED))
        .when(capped, F.lit(rules.SKIPPED))
        .otherwise(F.col(status)),
    )
    return out.drop("_is_event", "_bytes", "_sum", *([] if used else ["used_before"]))


def station_gate(visits: DataFrame, order: list[str], key: list[str], cap_bytes: int, initial_bytes: int = 0,
                 station: str = "station_ord", status: str = "status", restricted: str = "restricted",
                 size: str = "size_bytes", on_disk: str | None = None) -> DataFrame:
    """Per station: bytes it adds, bytes on disk before it starts, and whether it is harvested.

    A station that starts at or above the cap is not harvested (nor are later
    ones). The per-station table has one row per station (a handful), so its
    prefix sum is a plain window.
    """
    ev = byte_events(visits, order, key, status, restricted, size, on_disk, station)
    per = ev.groupBy(station).agg(F.sum(size).cast("bigint").alias("station_bytes"))
    allst = visits.select(station).distinct()
    j = allst.join(per, station, "left").fillna(0, ["station_bytes"])
    w = Window.orderBy(station).rowsBetween(Window.unboundedPreceding, -1)
    before = (F.coalesce(F.sum("station_bytes").over(w), F.lit(0)) + F.lit(initial_bytes)).cast("bigint")
    return j.select(station, "station_bytes", before.alias("used_before")).withColumn(
        "harvested", F.col("used_before") < cap_bytes
    )
