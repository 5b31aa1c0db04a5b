"""Order-dependent computations without a single-task window.

A window with ``orderBy`` and no ``partitionBy`` moves every row to one task. The
helpers here give the same numbers with a range shuffle instead:

1. rows go to ranges of the full (total) order key, whose bounds come from a sample
   of the key, so a hot leading key is split across ranges by the later keys;
2. each range is numbered / summed locally in order;
3. the totals of the ranges (one row each: bounded by their number, so safe to
   broadcast or to bring to the driver) give the offset of every range.

An ordinal takes Spark's own ranges (``repartitionByRange``). Their number and the local
position are fixed by a reliable ``checkpoint`` (into ``spark.checkpoint.dir``, or as
compressed columns in the scratch folder there) before they are used twice, so a lost
executor cannot renumber rows between the two uses. The input needs no checkpoint of its
own: it is usually an aggregate, whose shuffle output the sampling pass reuses.

A running sum takes given bounds (``cut_points``), so a row's range is a column: the rows
are shuffled once and written nowhere, and whatever runs again gives the same sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stored

_LOCAL_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row index


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, order: list[Column], n: int | None, compact: bool = False) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    # the sampling pass for the range bounds repeats only what follows the input's last
    # shuffle: adaptive execution has the shuffle's output by then
    ranged = (
        df.repartitionByRange(_partitions(df, n), *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return stored(ranged, "ranged") if compact else ranged.checkpoint(eager=True)


def _offsets(totals: DataFrame, value: str) -> DataFrame:
    """Exclusive prefix sum over the (few) partition totals."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_off", F.coalesce(F.sum(value).over(w), F.lit(0)).cast("bigint"))


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal", start: int | Column = 1,
                 partitions: int | None = None, compact: bool = False) -> DataFrame:
    """Add a dense 1..n position (plus ``start - 1``) over a total ``order``.

    Equal to ``row_number() over (order by ...)`` when the order is total. ``compact`` keeps the
    rows as compressed columns, for wide rows of which later steps read some columns each.
    """
    x = _ranged(df, order, partitions, compact)
    pid = F.shiftright("_mid", _LOCAL_BITS)
    totals = x.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offs = F.broadcast(_offsets(totals, "_n").select("_pid", "_off"))
    base = start if isinstance(start, Column) else F.lit(start)
    out = x.join(offs, pid == offs["_pid"], "inner").withColumn(
        name,
        (F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + base).cast("bigint"),
    )
    return out.drop("_mid", "_pid", "_off")


#: Sampled positions for each range; as many as Spark takes for its own ranges.
SAMPLED_PER_RANGE = 100


def cut_points(df: DataFrame, order: list[str], partitions: int | None = None) -> list[tuple]:
    """Positions (values of ``order``, ascending, nulls first) that cut ``df`` into ranges of about equally many rows.

    A cut holds no more leading columns than tell it from the sampled row before it (the rest is null, the
    least value), so rows are compared with few columns unless a leading key is hot.
    """
    n = _partitions(df, partitions)
    keys = df.select(*order)
    rows = keys.count()
    if n < 2 or not rows:
        return []
    share = min(1.0, SAMPLED_PER_RANGE * n / rows)
    sampled = [tuple(r) for r in keys.sample(False, share, 7).orderBy(*order).collect()]
    cuts = []
    for at in sorted({len(sampled) * i // n for i in range(1, n)}):
        while 0 < at < len(sampled) and sampled[at - 1] == sampled[at]:
            at += 1
        if 0 < at < len(sampled):
            k = next(k for k, (a, b) in enumerate(zip(sampled[at - 1], sampled[at], strict=True)) if a != b)
            cuts.append(sampled[at][:k + 1] + (None,) * (len(order) - k - 1))
    return list(dict.fromkeys(cuts))


def _from(at: list[Column], cut: list[Column], strictly: bool) -> Column:
    """Whether a position comes at or after ``cut`` (``strictly``: after it), nulls first."""
    here = F.lit(not strictly)
    for a, c in reversed(list(zip(at, cut, strict=True))):
        here = (a.isNotNull() & (c.isNull() | F.coalesce(a > c, F.lit(False)))) | (a.eqNullSafe(c) & here)
    return here


def comes_after(df: DataFrame, order: list[str], position: Row | tuple) -> Column:
    """Whether a row of ``df`` comes after a position in ``order`` (ascending, nulls first); never null."""
    return _from([F.col(c) for c in order], [F.lit(v).cast(df.schema[c].dataType) for c, v in zip(order, position, strict=True)], True)


def with_range(df: DataFrame, order: list[str], cuts: list[tuple], name: str = "_pid") -> DataFrame:
    """Add the number of ``cuts`` at or before a row's position: a binary search, whose steps are an array that is folded."""
    used = max((k + 1 for cut in cuts for k, v in enumerate(cut) if v is not None), default=0)
    if any(all(v is None for v in cut) for cut in cuts):
        used = max(used, 1)
    tables = [F.array(*[F.lit(cut[k]).cast(df.schema[c].dataType) for cut in cuts]) for k, c in enumerate(order[:used])]
    if not cuts:
        return df.withColumn(name, F.lit(0))

    def go_on(below: Column, step: Column) -> Column:
        reached = _from([F.col(c) for c in order[:used]], [F.get(t, below + step - F.lit(1)) for t in tables], False)
        return F.when((below + step <= F.lit(len(cuts))) & reached, below + step).otherwise(below)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return df.withColumn(name, F.aggregate(steps, F.lit(0), go_on))


def _range_totals(df: DataFrame, value: str, ranges: int) -> list[int]:
    """Sum of ``value`` in each range (one row a range reaches the driver)."""
    sums = dict(map(tuple, df.where(F.col(value) != 0).groupBy("_pid").agg(F.sum(value)).collect()))
    return [int(sums.get(i) or 0) for i in range(ranges)]


def with_running_sum(df: DataFrame, order: list[str | Column], value: Column, name: str = "running", exclusive: bool = True,
                     partitions: int | None = None, cuts: list[tuple] | None = None, ties: list[str] | None = None) -> DataFrame:
    """Add the running sum of ``value`` over a total ``order`` (ascending, nulls first; then ``ties``).

    ``exclusive`` sums the rows strictly before (rows between unbounded preceding
    and 1 preceding, 0 for the first row); otherwise the row itself is included.
    ``cuts`` (of ``cut_points``) are positions of ``order`` that share the rows out; without, they come from ``df``.
    """
    columns = {f"_o{i}": c for i, c in enumerate(order) if not isinstance(c, str)}
    df, order, ties = df.withColumns(columns), [c if isinstance(c, str) else f"_o{i}" for i, c in enumerate(order)], ties or []
    cuts = cut_points(df, order, partitions) if cuts is None else cuts
    x = with_range(df.withColumn("_v", F.coalesce(value.cast("bigint"), F.lit(0))), order, cuts)
    before = [0]
    for total in _range_totals(x, "_v", len(cuts) + 1):
        before.append(before[-1] + total)
    local = Window.partitionBy("_pid").orderBy(*order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    offset = F.get(F.array(*[F.lit(b).cast("bigint") for b in before[:-1]]), F.col("_pid"))
    total = F.sum("_v").over(local) + offset
    out = x.repartitionById(len(cuts) + 1, F.col("_pid")).withColumn(name, (total - F.col("_v") if exclusive else total).cast("bigint"))
    return out.drop("_pid", "_v", *columns)


def position_of_sum(df: DataFrame, order: list[str], value: str, target: int) -> Row | None:
    """The first position at which the running sum of ``value`` (not negative) over ``order`` reaches ``target``, None if it never does.

    The totals of the ranges show the range it lies in; only that one's rows are ordered.
    """
    cuts = cut_points(df, order)
    x = with_range(df, order, cuts)
    left, at = target, 0
    for at, total in enumerate(_range_totals(x, value, len(cuts) + 1)):
        if total >= left:
            break
        left -= total
    else:
        return None
    held = stored(x.where(F.col("_pid") == at).drop("_pid"), "sum-range")
    run = with_running_sum(held, order, F.col(value), name="_sum", exclusive=False)
    found = run.where(F.col("_sum") >= left).agg(F.min(F.struct(*order)).alias("at")).first()
    return found["at"]


def positions_at(df: DataFrame, order: list[str], places: list[int]) -> list[tuple | None]:
    """Positions of the rows that stand at ``places`` (from 1, ascending) of the total ``order``; None beyond its end.

    Only the rows of the ranges that hold a place are ordered.
    """
    cuts = cut_points(df, order)
    x = with_range(df, order, cuts)
    counts = dict(map(tuple, x.groupBy("_pid").count().collect()))
    inside, before, left = {}, 0, list(places)  # range -> places within it
    for at in sorted(counts):
        inside[at] = [p - before for p in left if p - before <= counts[at]]
        left = left[len(inside[at]):]
        before += counts[at]
    held = stored(x.where(F.col("_pid").isin([at for at, here in inside.items() if here])).select("_pid", *order), "place-ranges")
    found = []
    for at, here in inside.items():
        if here:
            rows = with_ordinal(held.where(F.col("_pid") == at), [F.col(c) for c in order], name="_at")
            named = {r["_at"]: tuple(r[c] for c in order) for r in rows.where(F.col("_at").isin(here)).collect()}
            found += [named[p] for p in here]
    return found + [None] * len(left)


def range_bounds(ids: DataFrame, column: str, ranges: int) -> list:
    """Upper bounds (inclusive, ascending, distinct) of ``ranges`` ranges of a number that hold about equally many rows, but the last range's."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    found = ids.agg(F.percentile_approx(column, shares, 100 * ranges)).first()[0]
    return sorted(set(found or []))


def order_by_ranges(df: DataFrame, column: str, bounds: list, order: list[Column]) -> DataFrame:
    """``df`` ordered by ``order``, whose first is ``column`` ascending, nulls first: one range of ``column`` a partition, each sorted.

    The result is that of ``orderBy``. That finds its ranges in the rows themselves, so all steps since the last
    shuffle run twice; here they are given. Rows of one value stay in one partition.
    """
    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) <= bounds[middle], place(low, middle)).otherwise(place(middle + 1, high))

    at = F.when(F.col(column).isNull(), F.lit(0)).otherwise(place(0, len(bounds)))
    return df.repartitionById(len(bounds) + 1, at).sortWithinPartitions(*order)
