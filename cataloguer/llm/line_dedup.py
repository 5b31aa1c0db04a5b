r"""Line dedup: exact and near repeats of lines, by a segment-partition edit join (native operations only).

A line is dropped if an earlier line equals it or is within ``max_edits`` edits of it
(earlier: smaller doc_id, then place in the text). Lines under ``min_exact`` characters always stay, lines under ``min_near`` are
compared for equality only: they are headings, list ends and table cells, and
their repeats are no sign of copied text. The rest of the text stays in order.

The edit join follows the pigeonhole principle. A line of length L is cut in
``max_edits + 1`` segments; two lines within ``max_edits`` edits share one whole
segment, near its place. A line indexes its own segments, and probes, for each
index length from its own down to ``max_edits`` less, the substrings that can meet a
segment of such a line (only starts that leave enough edits on both sides). A
bucket holds the lines with the same (length, segment number, segment). Buckets of
one line, nearly all, end in one window pass. Others are verified by a banded
bit-parallel edit distance:

* first against one pivot a bucket, the line that meets most others, and the
  bucket's earliest line; lines that have found an earlier neighbour need no more;
* lines still open in buckets of more than ``cell`` lines are cut again: what is
  left of the line without the shared segment is joined in the same way inside the
  bucket, so a bucket of a common phrase splits by the text around it. This is repeated,
  pivots included, while such a bucket has more than ``deep`` lines and its rests are longer than a few characters;
* lines still open are compared with the earlier lines of their small buckets.

Before the exact comparison the counts of some letters are compared: an edit
changes them by at most two in sum, so pairs that differ more are out.

Defined cases: null text stays null, empty stays empty; lines end at ``\n`` only and
are compared as they are; rows with equal doc_id and text are one text (a repeated
row keeps what the first keeps); a null doc_id is earlier than any; extra columns
stay, but for those named like a result; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import screen
from .quality import SPACES
from .registry import written


#: Letters whose counts screen pairs before the exact comparison.
PROFILE = "etanoirshdlugbywcmpf"


@dataclass(frozen=True)
class LineParams:
    """Production parameters."""

    max_edits: int = 2
    min_exact: int = 30
    min_near: int = 60
    cell: int = 64
    deep: int = 1024


def probes(max_edits: int) -> list[tuple[int, int, int]]:
    """(length less by, segment number, shift of the start) of every substring a line looks up.

    The first ``max_edits + 1`` are the line's own segments.
    """
    k = max_edits
    out = [(0, i, 0) for i in range(k + 1)]
    for less in range(k + 1):
        for i in range(k + 1):
            low = max(-i, less - (k - i))
            high = min(i, less + (k - i))
            out += [(less, i, s) for s in range(low, high + 1) if (less, s) != (0, 0)]
    return out


def _with_places(lines: DataFrame, max_edits: int) -> DataFrame:
    """``lines`` (.., n) with the 1-based start and the size of each segment of each index length, as columns.

    Later segments take the remainder of a length. Plain integer columns, worked out once per line.
    """
    parts, cols = max_edits + 1, []
    for less in range(parts):
        length = F.col("n") - less
        base, rest = F.expr(f"cast((n - {less}) div {parts} as int)"), length % parts
        for i in range(parts):
            over = F.greatest(F.lit(0), F.lit(i) - (parts - rest)).cast("int")
            cols += [(1 + i * base + over).cast("int").alias(f"_s{less}_{i}"),
                     (base + F.when(F.lit(i) >= parts - rest, 1).otherwise(0)).cast("int").alias(f"_z{less}_{i}")]
    return lines.select("*", *cols)


def _substrings(max_edits: int) -> list[tuple[int, int, Column, Column]]:
    """(length less by, segment, start, size) of each probe, over the columns of ``_with_places``."""
    return [(less, i, F.col(f"_s{less}_{i}") + shift, F.col(f"_z{less}_{i}")) for less, i, shift in probes(max_edits)]


def bucket_rows(lines: DataFrame, max_edits: int) -> DataFrame:
    """``lines`` (id, s, n and some of scope, piece, live) as rows (.., slot, key) of every index and probe substring, without s and n."""
    keys, own = [], [c for c in lines.columns if c not in ("s", "n")]
    scope = F.col("scope") if "scope" in own else F.lit(0).cast("long")
    for less, i, start, size in _substrings(max_edits):
        key = F.xxhash64(scope, F.col("n") - less, F.lit(i), F.col("s").substr(start, size))
        # in a line of fewer characters than that a probe may not fit; none is needed there
        keys.append(F.when((start >= 1) & (start + size <= F.col("n") + 1), key))
    placed = _with_places(lines.select(*own, "s", F.col("n").cast("int").alias("n")), max_edits)
    return placed.select(*own, F.posexplode_outer(F.array(*keys)).alias("slot", "key")).where("key is not null")


def shared_buckets(rows: DataFrame, max_edits: int) -> DataFrame:
    """(key, scope, id, piece, slots, size) of buckets that hold two lines or more, a live one, and one by its own segment.

    ``size`` is the bucket's number of lines, counted where its rows are together anyway, so no later step has to join it. Whole lines, the largest level by far, come as (id, slot, key) alone: all live, in scope 0, each its own piece.
    """
    w, whole = Window.partitionBy("key"), "piece" not in rows.columns
    met = rows.withColumn("_lo", F.min("id").over(w)).withColumn("_hi", F.max("id").over(w)).withColumn("_own", F.min("slot").over(w))
    if not whole:
        met = met.withColumn("_live", F.max("live").over(w)).where("_live")
    met = met.where((F.col("_lo") != F.col("_hi")) & (F.col("_own") <= max_edits))
    if whole:
        met = met.withColumns({"scope": F.lit(0).cast("long"), "piece": F.col("id")})
    met = met.groupBy("key", "scope", "id", "piece").agg(F.collect_set("slot").alias("slots"))
    return met.withColumn("size", F.dense_rank().over(w.orderBy("id"))).withColumn("size", F.max("size").over(w))


def with_live(large: DataFrame) -> DataFrame:
    """``large`` (key, scope, id, ..) with ``live``, less the buckets without a live line.

    Lines of one template share several buckets. Most lines of a bucket have some
    smaller bucket ``d`` as their first: two lines that both have it meet there, so here only pairs
    with another line, a live one, are of interest.
    """
    first = large.groupBy("scope", "id").agg(F.min("key").alias("m"))
    marked = large.join(first, ["scope", "id"])
    marked = with_bucket(marked, d=F.mode("m", True)).withColumn("live", (F.col("d") == F.col("key")) | (F.col("m") != F.col("d"))).drop("d", "m")
    return marked.join(marked.where("live").select("key").distinct(), "key", "left_semi")


def with_bucket(rows: DataFrame, **aggregates: Column) -> DataFrame:
    """``rows`` (key, ..) with aggregates over their bucket: partial sums, then a join, so that a large bucket is no single task."""
    return rows.join(rows.groupBy("key").agg(*[c.alias(name) for name, c in aggregates.items()]), "key")


def remainders(lines: DataFrame, max_edits: int) -> DataFrame:
    """``lines`` (.., s, n, slot) with ``rest``: s without the substring of its slot; a NUL keeps the two sides apart."""
    lines = lines.withColumn("n", F.col("n").cast("int"))
    s, out = F.col("s"), F.lit(None).cast("string")
    for slot, (_, _, start, size) in enumerate(_substrings(max_edits)):
        out = F.when(F.col("slot") == slot, F.concat(s.substr(F.lit(1), start - 1), F.lit("\x00"), s.substr(start + size, F.col("n")))).otherwise(out)
    return _with_places(lines, max_edits).withColumn("rest", out)


def profile(s: Column) -> list[Column]:
    """How often each of some letters occurs: an edit changes the sum of these counts' differences by at most two."""
    return [(F.char_length(s) - F.char_length(F.replace(s, F.lit(c), F.lit("")))).alias(f"c{k}") for k, c in enumerate(PROFILE)]


def profiles_allow(x: str, y: str, max_edits: int) -> Column:
    """Whether two rows' lengths and profiles (columns with prefixes x and y) allow so few edits."""
    total = F.lit(0)
    for k in range(len(PROFILE)):
        total = total + F.abs(F.col(f"{x}c{k}") - F.col(f"{y}c{k}"))
    return (F.abs(F.col(f"{x}n") - F.col(f"{y}n")) <= max_edits) & (total <= 2 * max_edits)


def within_edits(a: Column, b: Column, max_edits: int) -> Column:
    """Whether two texts are within ``max_edits`` edits: banded bit-parallel edit distance.

    One column of the band has 2k + 1 cells; bit q of the vectors stands for the
    vertical difference at row ``j - k + q`` of column j. The distance is followed
    along the band's last diagonal and, once that reaches the longer text's end,
    along its last row.
    """
    k = max_edits
    band, top, mask = 2 * k + 1, 1 << (2 * k), (1 << (2 * k + 1)) - 1
    long_first = F.char_length(a) >= F.char_length(b)
    p = F.encode(F.when(long_first, a).otherwise(b), "UTF-32")
    t = F.encode(F.when(long_first, b).otherwise(a), "UTF-32")
    m, n = F.octet_length(p) / 4, F.octet_length(t) / 4

    def bit(x: Column) -> Column:
        return x.cast("int")

    def column(state: Column, j: Column) -> Column:
        """State after column j (1-based) of the shorter text."""
        pat, txt, rows = state["p"], state["t"], state["m"]
        c = txt.substr(4 * j - 3, F.lit(4))
        eq = F.lit(0)
        for q in range(band):
            row = j - k + q
            hit = (row >= 1) & (row <= rows) & (pat.substr(F.greatest(4 * row - 3, F.lit(1)), F.lit(4)) == c)
            eq = eq + F.when(hit, 1 << q).otherwise(0)
        return F.struct(pat.alias("p"), txt.alias("t"), rows.alias("m"), state["vp"].alias("vp"), state["vn"].alias("vn"), state["d"].alias("d"), eq.alias("eq"), j.alias("j"))

    def advance(state: Column) -> Column:
        vp, vn, eq, j = state["vp"], state["vn"], state["eq"], state["j"]
        carry = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)
        return F.struct(*[state[c].alias(c) for c in ("p", "t", "m", "vp", "vn", "d", "j")],
                        carry.bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(mask)).alias("d0"))

    def finish(state: Column) -> Column:
        vp, vn, d0, j = state["vp"], state["vn"], state["d0"], state["j"]
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(F.lit(mask)))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        last = j + k - state["m"]  # rows of the band below the longer text's end
        diagonal = 1 - bit(d0.bitwiseAND(F.lit(top)) != 0)
        at = F.lit(2 * k) - last
        level = bit(F.getbit(hp, F.greatest(at, F.lit(0))) != 0) - bit(F.getbit(hn, F.greatest(at, F.lit(0))) != 0)
        return F.struct(
            state["p"].alias("p"), state["t"].alias("t"), state["m"].alias("m"),
            hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(mask))).alias("vp"), down.bitwiseAND(hp).alias("vn"),
            (state["d"] + F.when(last <= 0, diagonal).otherwise(level)).alias("d"),
        )

    def let(value: Column, body) -> Column:
        """``body`` of a value that is worked out once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    begin = F.struct(p.alias("p"), t.alias("t"), m.cast("int").alias("m"), F.lit(((1 << (k + 1)) - 1) << k).alias("vp"), F.lit(0).alias("vn"), F.lit(k).alias("d"))
    steps = F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    distance = F.aggregate(steps, begin, lambda st, j: let(column(st, j), lambda x: let(advance(x), finish)), lambda st: st["d"])
    near = F.abs(F.char_length(a) - F.char_length(b)) <= k
    return near & F.when(n == 0, m <= k).otherwise(distance <= k)


def _lines(docs: DataFrame, params: LineParams) -> DataFrame:
    """One row per line that may be dropped: (doc_id, th, line_no, n, h1, h2, line)."""
    return (
        docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"), F.posexplode_outer(F.split("text", "\n", -1)).alias("line_no", "line"))
        .withColumn("n", F.char_length("line")).where((F.col("n") >= params.min_exact) & (F.ltrim("line", F.lit(SPACES)) != ""))
        .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))
    )


def _first() -> Column:
    return F.struct("doc_id", "th", "line_no")


def near_links(docs: DataFrame, classes: DataFrame, params: LineParams) -> DataFrame:
    """h1 of the lines with an earlier line within ``max_edits`` edits."""
    k, tasks = params.max_edits, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = _lines(docs, params).where(F.col("n") >= params.min_near)
    rows = bucket_rows(near.select(F.col("h1").alias("id"), F.col("line").alias("s"), "n"), k)
    level = written(shared_buckets(rows, k), "line-buckets")
    wanted = written(level.select("id").distinct().join(classes.select(F.col("h1").alias("id"), "first"), "id"), "line-wanted")
    # a wanted line's text is taken from its first place only
    place = wanted.select(F.col("first.doc_id").alias("_d"), F.col("first.th").alias("_t"), F.col("first.line_no").alias("_l"))
    found = (
        near.where(screen(wanted, "id")(F.col("h1")))
        .join(place, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("line_no") == F.col("_l")), "left_semi")
        .select(F.col("h1").alias("id"), F.col("line").alias("s"), "n", _first().alias("first"), *profile(F.col("line"))).dropDuplicates(["id"])
    )
    lines = written(found, "line-texts")
    counts = [f"c{i}" for i in range(len(PROFILE))]
    order = lines.select("id", "first", "n", *counts)

    def side(name: str) -> DataFrame:
        return order.drop("first").withColumnsRenamed({"id": name, "n": f"{name}_n"} | {c: f"{name}_{c}" for c in counts})

    def verified(pairs: DataFrame) -> DataFrame:
        """Ids of later lines among (x later, y earlier) pairs that are within the edits."""
        likely = pairs.distinct().join(side("x"), "x").join(side("y"), "y").where(profiles_allow("x_", "y_", k)).select("x", "y")
        one = lines.select(F.col("id").alias("x"), F.col("s").alias("sx"))
        two = lines.select(F.col("id").alias("y"), F.col("s").alias("sy"))
        # a comparison costs far more than its bytes, so the number of tasks is not to follow them
        texts = likely.join(one, "x").join(two, "y").repartition(tasks, "x", "y")
        return texts.where(within_edits(F.col("sx"), F.col("sy"), k)).select(F.col("x").alias("id")).distinct()

    def flagged(rows: DataFrame, done: DataFrame | None) -> DataFrame:
        """``rows`` (key, id, ..) with their line's ``first``, ``pop`` (its rows) and ``open``: whether it has found no earlier neighbour yet.

        A line's rows travel as one, so it is looked up once, not once a bucket. Written, as the steps after it use it more than once.
        """
        own = [c for c in rows.columns if c not in ("id", "first", "pop", "open")]
        by_line = rows.groupBy("id").agg(F.collect_list(F.struct(*own)).alias("_rows")).join(order.select("id", "first"), "id")
        is_open = F.lit(True)
        if done is not None:
            by_line, is_open = by_line.join(done.withColumn("_done", F.lit(1)), "id", "left"), F.col("_done").isNull()
        return written(by_line.select("id", "first", F.size("_rows").alias("pop"), is_open.alias("open"), F.inline("_rows")), "line-open")

    def unsettled(rows: DataFrame) -> DataFrame:
        """Rows (key, id, first, open, ..) of buckets with an open line that is not their earliest."""
        ends = rows.groupBy("key").agg(F.min("first").alias("earliest"), F.max(F.when(F.col("open"), F.col("first"))).alias("last_open"))
        return rows.join(ends.where(F.col("last_open") > F.col("earliest")).select("key"), "key", "left_semi")

    def star(rows: DataFrame) -> DataFrame:
        """Open lines of a bucket against the line that is in most buckets, and the earliest; in a bucket of two, most of all, no row meets another than by the aggregate."""
        members = rows.select("key", "id", "first", "pop", "open", "size").distinct()
        two = members.where("size = 2").groupBy("key").agg(F.max(F.struct("first", "id", "open")).alias("x"), F.min(F.struct("first", "id")).alias("y"))
        pairs = two.where(F.col("x.open") & (F.col("x.first") > F.col("y.first"))).select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))
        more = members.where("size > 2").drop("size")
        around = with_bucket(more, pivot=F.max(F.struct("pop", "id", "first")), earliest=F.min(F.struct("first", "id"))).where("open")
        both = F.array(*[F.struct(F.col(f"{c}.first").alias("first"), F.col(f"{c}.id").alias("id")) for c in ("pivot", "earliest")])
        return pairs.union(around.select(F.col("id").alias("x"), "first", F.explode(both).alias("y")).where(
            F.col("first") > F.col("y.first")).select("x", F.col("y.id").alias("y")))

    pieces = lines.select(F.col("id").alias("piece"), "s", "n")
    done, small, cell = None, None, params.cell
    while True:
        marked = flagged(level, done)
        fresh = verified(star(marked))
        done = written(fresh if done is None else done.union(fresh).distinct(), "line-done")
        # a bucket of two is settled; whether a small one is, is looked up once, when no line can be closed any more
        few = marked.where((F.col("size") > 2) & (F.col("size") <= cell)).select("key", "id")
        small = few if small is None else small.unionByName(few)
        large = written(unsettled(flagged(marked.where(F.col("size") > cell), done)), "line-buckets")
        if large.isEmpty():
            break
        large = written(with_live(large), "line-large")
        cut = remainders(large.select("key", "id", "piece", "live", F.explode("slots").alias("slot")).join(pieces, "piece"), k).select(
            F.col("key").alias("scope"), "id", "live", "rest")
        # a separator could be the whole of a short rest's segment; without it each cut leaves less
        size = cut.groupBy("scope").agg(F.max(F.char_length("rest")).alias("longest"))
        bare = F.when(F.col("longest") > 4 * k + 2, F.col("rest")).otherwise(F.replace("rest", F.lit("\x00"), F.lit("")))
        cut = cut.join(size, "scope").select("scope", "id", "live", bare.alias("s")).distinct().withColumn("n", F.char_length("s"))
        cut = written(cut.withColumn("piece", F.xxhash64("scope", "id", "s")), "line-pieces")
        longest = cut.groupBy("scope").agg(F.max("n").alias("longest"))
        short = longest.where(F.col("longest") <= 3 * k).select(F.col("scope").alias("key"))
        small = small.unionByName(large.join(short, "key", "left_semi").select("key", "id"))
        pieces = cut.join(longest.where(F.col("longest") > 3 * k).select("scope"), "scope", "left_semi")
        level = written(shared_buckets(bucket_rows(pieces, k), k), "line-buckets")
        pieces, cell = pieces.select("piece", "s", "n"), params.deep
    left = unsettled(flagged(small.select("key", "id").distinct(), done))
    # a pair is compared in one of the buckets it shares, the one of the smallest key
    by_line = left.groupBy("id", "open").agg(F.collect_set("key").alias("keys")).join(order, "id")
    left = written(by_line.withColumn("key", F.explode("keys")).repartition(tasks, "key"), "line-members")
    other = left.withColumnsRenamed({"id": "y", "first": "y_first", "n": "y_n", "keys": "y_keys"} | {c: f"y_{c}" for c in counts}).drop("open")
    left = left.where("open").withColumnsRenamed({"id": "x", "n": "x_n"} | {c: f"x_{c}" for c in counts})
    once = F.array_min(F.array_intersect("keys", "y_keys")) == left["key"]
    met = (left["key"] == other["key"]) & profiles_allow("x_", "y_", k) & (F.col("first") > F.col("y_first")) & once
    rest = written(left.repartition(tasks, "key").join(other.repartition(tasks, "key"), met).select("x", "y"), "line-rest")
    return written(done.union(verified(rest)).distinct(), "line-near")


def dedup_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and n_lines, n_exact, n_near (lines dropped)."""
    results = ["n_lines", "n_exact", "n_near"]
    texts = docs.select("doc_id", "text")
    places = written(_lines(texts, params).select("doc_id", "th", "line_no", "h1", "h2"), "line-places")
    classes = written(places.groupBy("h1", "h2").agg(F.min(_first()).alias("first"), F.max(_first()).alias("last")), "line-classes")
    near = near_links(texts, classes, params)
    marked = classes.join(near.withColumn("near", F.lit(True)), classes["h1"] == near["id"], "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("first"), F.coalesce("near", F.lit(False)).alias("near"),
        (F.col("first") < F.col("last")).alias("again"),
    ).where("near or again")
    drops = (
        places.join(marked, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
        .withColumn("later", _first() > F.col("first")).where("near or later")
        .groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
        .agg(F.collect_set("line_no").alias("_drop"), F.countDistinct(F.when(F.col("later"), F.col("line_no"))).alias("_exact"))
    )
    # all input columns travel as one: no name can clash with a step's
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row")).withColumn("_th", F.xxhash64("_row.text"))
    lines = rows.join(drops, F.col("_row.doc_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left").select(
        "_row", F.split("_row.text", "\n", -1).alias("_lines"), "_drop", "_exact")
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.array_join(F.transform(F.array_except(every, F.col("_drop")), lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("_drop").isNull(), F.col("_row.text")).otherwise(kept)
    gone = F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long")
    exact = F.coalesce("_exact", F.lit(0)).cast("long")
    # a generator is a barrier: a filter on the results stays above, else each reference to the lines becomes another split
    done = lines.select("_row", F.inline_outer(F.array(F.struct(
        text.alias("_text"), F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        exact.alias("n_exact"), (gone - exact).alias("n_near"),
    ))))
    return done.select(
        *[F.col("_text").alias(c) if c.lower() == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in results], *results
    )
