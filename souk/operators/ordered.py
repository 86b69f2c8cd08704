"""Skew-safe ordered window operators: rank, row number, running sum and
maximum, moving sums, lag/lead.

A plain ``Window.partitionBy(g).orderBy(k)`` sends every row of group ``g``
to one task.  That is fine while groups are small, but one customer (or the
single group of a global ranking) may hold a large share of all rows.  The
operators here give the same answer as the plain window and bound the rows a
task handles:

1. ``segments``: a hash of the whole row picks a sample of about
   ``64 / max_rows`` of the rows.  Per group the sample, in sort order, gives
   the quantiles: every 32nd sampled row is a cut.  A row's segment is the
   number of cuts not after it, found by binary search.  Cuts are whole sort
   keys plus the row hash, compared as Spark compares them, so any sortable
   type works (strings, NaN, infinities, NULLs, mixed directions), rows of
   one tied key are spread over segments too, and segment order follows sort
   order.  Groups without cuts keep one segment.
2. The window runs per ``(group, segment)``.
3. Per ``(group, segment)`` of split groups, a small summary (row count, total,
   first/last value) is accumulated over earlier segments with a window
   partitioned by group and joined back to correct the local results.

The result is exact for any choice of cuts; they only affect balance.  The
sample depends on row contents alone (no random numbers, partition ids or
merge order), so every branch of a plan and every recomputation after an
executor loss cuts alike.  Nothing is collected to the driver and the number
of segments has no cap.  Rows equal in every column stay together.

All operators take ``rows``, an upper bound of the input's rows where one is
known (file footers give a table's count for next to nothing).  Up to
``max_rows`` of them no group can need a split, so the plan is the plain
window.  Beyond, the bound says how many cuts there can be: few enough are
broadcast, more are left to the join strategy that Spark chooses, as they are
when no bound is given.  A bound that is too low costs balance, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows one window task may hold before its group is split.  Overridable per
# session with the SQL conf ``souk.window.maxRows`` (or per call).
DEFAULT_MAX_ROWS = 5_000_000
MAX_ROWS_CONF = "souk.window.maxRows"
# Sampled rows between two cuts.  A segment holds max_rows / 2 rows on
# average; the chance of one with twice that many is below 1e-4.
SAMPLES_PER_SEGMENT = 32
# Cuts that may be broadcast (some tens of bytes each for usual sort keys).
BROADCAST_CUTS = 100_000

SEG = "_seg"
GK = "_gk"      # the group key as one non-NULL struct: NULL-safe with plain equality
TIE = "_tie"    # hash of the row: orders rows of equal sort keys
_K, _CUTS = "_seg_k", "_seg_cuts"


@dataclass(frozen=True)
class Sort:
    """One sort key.  Spark's defaults apply: ascending puts NULLs first,
    descending puts them last."""

    col: str
    desc: bool = False

    def column(self) -> Column:
        c = F.col(self.col)
        return c.desc() if self.desc else c.asc()


def asc(c: str) -> Sort:
    return Sort(c, False)


def desc(c: str) -> Sort:
    return Sort(c, True)


def resolve_max_rows(df: DataFrame, max_rows: int | None) -> int:
    """``max_rows`` if given, else the session's ``souk.window.maxRows``,
    else :data:`DEFAULT_MAX_ROWS`."""
    if max_rows is not None:
        return int(max_rows)
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))


def _sum_type(dtype: T.DataType) -> T.DataType:
    """Result type of ``sum`` over ``dtype`` (Spark's rule)."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def _hashable(dtype: T.DataType) -> bool:
    return not dtype.simpleString().startswith(("map", "variant"))


def _with_tie(order: Sequence[Sort]) -> list[Sort]:
    """The order made total (up to equal rows) by the row hash."""
    return [*order, Sort(TIE, order[-1].desc)]


def _blocks(order: Sequence[Sort]) -> list[tuple[bool, list[str]]]:
    """Neighbouring sort keys of one direction: each block compares as one struct."""
    out: list[tuple[bool, list[str]]] = []
    for s in order:
        if not out or out[-1][0] != s.desc:
            out.append((s.desc, []))
        out[-1][1].append(s.col)
    return out


def _not_after(cut: Column, row: Column, directions: Sequence[bool]) -> Column:
    """``cut`` sorts before ``row`` or equal to it.  Struct comparison puts
    NULL fields first, and descending order is its exact reverse."""
    def step(rest: Column | None, i: int) -> Column:
        a, b = cut[f"b{i}"], row[f"b{i}"]
        before = a > b if directions[i] else a < b
        return before | (a == b) if rest is None else before | ((a == b) & rest)
    return reduce(step, reversed(range(len(directions))), None)


def _cuts_before(cuts: Column, row: Column, directions: Sequence[bool]) -> Column:
    """Number of ``cuts`` (sorted) not after ``row``, by binary search."""
    powers = F.filter(F.array(*[F.lit(1 << i) for i in range(30, -1, -1)]), lambda p: p <= F.size(cuts))
    return F.aggregate(powers, F.lit(0), lambda at, p: F.when(
        (at + p <= F.size(cuts)) & _not_after(F.get(cuts, at + p - 1), row, directions), at + p).otherwise(at))


def _segments(df: DataFrame, schema: T.StructType, partition: Sequence[str],
              order: Sequence[Sort], max_rows: int | None, rows: int | None) -> DataFrame:
    max_rows = resolve_max_rows(df, max_rows)
    # One struct column stands for the group: struct equality treats NULL
    # fields as equal, so a NULL group key is a group like any other, and
    # window partitioning, aggregation and joins all use the same plain key
    # (the correction join then reuses the window's partitioning).
    base = df.withColumns({
        GK: F.struct(*partition) if partition else F.lit(0),
        TIE: F.xxhash64(*[f.name for f in schema.fields if _hashable(f.dataType)])})
    if rows is not None and rows <= max_rows:
        # no group has cuts: Spark sees that the corrections are empty
        return base.withColumns({SEG: F.lit(0).cast("long"), _K: F.lit(None).cast("int")})
    total = _with_tie(order)
    blocks = _blocks(total)
    directions = [d for d, _ in blocks]
    key = F.struct(*[F.struct(*cols).alias(f"b{i}") for i, (_, cols) in enumerate(blocks)])
    # every / of = the sampled share of rows; all rows when segments are tiny
    of = max_rows
    every = min(of, 2 * SAMPLES_PER_SEGMENT)
    step = max(1, every * max_rows // (2 * of))
    # Equal rows share a hash: counted before they meet, they stay one entry.
    sample = (base.where(F.pmod(F.xxhash64(TIE, F.lit("sample")), F.lit(of)) < every)
              .groupBy(GK, *dict.fromkeys(s.col for s in total)).agg(F.count(F.lit(1)).alias("_n")))
    by_group = Window.partitionBy(GK)
    upto = F.sum("_n").over(by_group.orderBy(*[s.column() for s in total]).rowsBetween(Window.unboundedPreceding, 0))
    cuts = (sample.withColumns({"_upto": upto, "_all": F.sum("_n").over(by_group)})
            .where((F.col("_all") > 2 * step)
                   & (F.floor(F.col("_upto") / step) > F.floor((F.col("_upto") - F.col("_n")) / step)))
            .groupBy(GK)
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("_upto", key.alias("_cut")))),
                             lambda c: c["_cut"]).alias(_CUTS)))
    if rows is not None and 2 * rows / max_rows <= BROADCAST_CUTS:
        cuts = F.broadcast(cuts)
    keep = [F.col(f.name) for f in schema.fields]
    seg = F.when(F.col(_CUTS).isNull(), F.lit(0)).otherwise(_cuts_before(F.col(_CUTS), key, directions))
    # ``_seg_k``: number of cuts, NULL for groups that stay whole
    return (base.join(cuts, on=GK, how="left")
            .select(*keep, F.col(GK), F.col(TIE), seg.cast("long").alias(SEG),
                    F.when(F.col(_CUTS).isNotNull(), F.size(_CUTS)).alias(_K)))


def segments(df: DataFrame, partition: Sequence[str], order: Sequence[Sort] | Sort,
             max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` plus the group key ``_gk``, the row hash ``_tie``, the segment
    ``_seg`` (ordered like ``order``, then ``_tie``, within each group) and
    the split marker ``_seg_k`` (NULL for groups that stay whole: those of up
    to about ``max_rows`` rows)."""
    order = [order] if isinstance(order, Sort) else list(order)
    return _segments(df, df.schema, partition, order, max_rows, rows)


def _per_segment(local: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """One row per (group, segment) of split groups."""
    return local.where(F.col(_K).isNotNull()).groupBy(GK, SEG).agg(*[a.alias(n) for n, a in aggs.items()])


def _earlier():
    """Segments of a group in order, and the frame of those before this one."""
    w = Window.partitionBy(GK).orderBy(SEG)
    return w, w.rowsBetween(Window.unboundedPreceding, -1)


def _window(order: Sequence[Sort]):
    return Window.partitionBy(GK, SEG).orderBy(*[s.column() for s in order])


def _corrected(local: DataFrame, prior: DataFrame, keep: Sequence[str],
               fixes: dict[str, Column]) -> DataFrame:
    """Left join the per-segment corrections on (group key, segment) and
    return the ``keep`` columns plus the corrected ``fixes``.

    The join keys are exactly the window's partitioning, so the rows are not
    shuffled again; only the small corrections table moves (or is broadcast
    by adaptive execution)."""
    joined = local.join(prior, on=[GK, SEG], how="left")
    return joined.select(*[F.col(c) for c in keep if c not in fixes],
                         *[e.alias(n) for n, e in fixes.items()])


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[Sort], out: str,
                method: str = "rank", max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``rank()`` / ``row_number()`` over ``partitionBy(partition).orderBy(order)``
    as a long column ``out``.

    A tied key may span segments: its rank is then the one at which the tie
    began, carried over the segments that hold nothing else.  ``row_number``
    breaks ties by the row hash."""
    if method not in ("rank", "row_number"):
        raise ValueError("method must be rank or row_number")
    schema = df.schema
    keep = [f.name for f in schema.fields]
    local = _segments(df, schema, partition, order, max_rows, rows)
    w, before = _earlier()
    rows_before = F.coalesce(F.sum("_c").over(before), F.lit(0))
    if method == "row_number":
        local = local.withColumn(out, F.row_number().over(_window(_with_tie(order))))
        prior = (_per_segment(local, {"_c": F.count(F.lit(1))})
                 .select(GK, SEG, rows_before.alias("_seg_before")))
        fix = F.col(out) + F.coalesce("_seg_before", F.lit(0))
        return _corrected(local, prior, [*keep, out], {out: fix.cast("long")})
    local = local.withColumn(out, F.rank().over(_window(order)))
    key = F.struct(*[s.col for s in order])
    per = _per_segment(local, {"_c": F.count(F.lit(1)), "_first": F.min_by(key, F.col(out)),
                               "_last": F.max_by(key, F.col(out)), "_top": F.max(out)})
    prior = (per.withColumns({"_seg_before": rows_before, "_seg_goes_on": F.lag("_last").over(w).eqNullSafe(F.col("_first"))})
             # the rank of the segment's last key, where that tie began here
             .withColumn("_seg_began", F.when(~(F.col("_seg_goes_on") & F.col("_first").eqNullSafe(F.col("_last"))),
                                          F.col("_seg_before") + F.col("_top")))
             .withColumn("_seg_tie_rank", F.last("_seg_began", ignorenulls=True).over(before))
             .select(GK, SEG, "_seg_before", F.when(F.col("_seg_goes_on"), F.col("_seg_tie_rank")).alias("_seg_carry")))
    fix = (F.when((F.col(out) == 1) & F.col("_seg_carry").isNotNull(), F.col("_seg_carry"))
           .otherwise(F.col(out) + F.coalesce("_seg_before", F.lit(0))))
    return _corrected(local, prior, [*keep, out], {out: fix.cast("long")})


def running_sums(df: DataFrame, sums: dict[str, str], partition: Sequence[str], order: Sequence[Sort],
                 exclusive: bool = False, max_rows: int | None = None,
                 rows: int | None = None) -> DataFrame:
    """``sum(value)`` for each ``out: value`` of ``sums`` over rows from the
    group start to the current row (``exclusive``: to the previous row; NULL
    when there is none)."""
    schema = df.schema
    keep = [f.name for f in schema.fields]
    frame = _window(_with_tie(order)).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    local = _segments(df, schema, partition, order, max_rows, rows).withColumns(
        {out: F.sum(value).over(frame) for out, value in sums.items()})
    _, earlier = _earlier()
    parts = {f"_seg_sum{i}": value for i, value in enumerate(sums.values())}
    prior = (_per_segment(local, {n: F.sum(value) for n, value in parts.items()})
             .select(GK, SEG, *[F.sum(n).over(earlier).alias(n) for n in parts]))
    fixes = {}
    for (out, value), n in zip(sums.items(), parts):
        # while a segment has summed no value yet (its first values are NULL, or
        # the frame is still empty) the total of the previous segments stands
        total = F.coalesce(F.col(out) + F.coalesce(F.col(n), F.lit(0)), F.col(n))
        fixes[out] = total.cast(_sum_type(schema[value].dataType))
    return _corrected(local, prior, [*keep, *sums], fixes)


def running_sum(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[Sort],
                out: str, exclusive: bool = False,
                max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """:func:`running_sums` of one column."""
    return running_sums(df, {out: value}, partition, order, exclusive, max_rows, rows)


def running_max(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[Sort],
                out: str, exclusive: bool = False,
                max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``max(value)`` from the group start to the current row (``exclusive``:
    to the previous row; NULL when there is none)."""
    schema = df.schema
    keep = [f.name for f in schema.fields]
    frame = _window(_with_tie(order)).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    local = _segments(df, schema, partition, order, max_rows, rows).withColumns(
        {out: F.max(value).over(frame)})
    _, earlier = _earlier()
    prior = (_per_segment(local, {"_m": F.max(value)})
             .select(GK, SEG, F.max("_m").over(earlier).alias("_seg_before")))
    return _corrected(local, prior, [*keep, out], {out: F.greatest(F.col(out), F.col("_seg_before"))})


def moving(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[Sort], width: int,
           total: str, count: str, max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Sum (``total``) and number (``count``) of the non-NULL ``value`` in the
    current and the ``width - 1`` previous rows (a ROWS frame).

    Across segments the frame is completed by halo rows: the last
    ``width - 1`` values before a segment, gathered from the tails of at most
    ``width - 1`` earlier ones, added to the segment's first rows."""
    if width < 1:
        raise ValueError("width must be at least 1")
    schema = df.schema
    keep = [f.name for f in schema.fields]
    w = _window(_with_tie(order))
    frame = w.rowsBetween(-(width - 1), 0)
    local = _segments(df, schema, partition, order, max_rows, rows).withColumns({
        total: F.sum(value).over(frame), count: F.count(value).over(frame), "_seg_at": F.row_number().over(w)})
    dtype = _sum_type(schema[value].dataType)
    if width == 1:
        return local.select(*[c for c in keep if c not in (total, count)], F.col(total).cast(dtype), count)
    size = F.count(F.lit(1)).over(Window.partitionBy(GK, SEG))
    tails = (local.where(F.col(_K).isNotNull()).withColumn("_seg_size", size)
             .where(F.col("_seg_size") - F.col("_seg_at") < width - 1)
             .groupBy(GK, SEG)
             .agg(F.sort_array(F.collect_list(F.struct("_seg_at", F.col(value).alias("v")))).alias("_seg_tail")))
    several = Window.partitionBy(GK).orderBy(SEG).rowsBetween(-(width - 1), -1)
    prior = tails.select(GK, SEG, F.flatten(F.collect_list("_seg_tail").over(several)).alias("_seg_halo"))
    n = F.least(F.size("_seg_halo"), F.lit(width) - F.col("_seg_at"))
    missing = F.when(F.col("_seg_halo").isNotNull() & (n > 0), F.filter(
        F.transform(F.slice("_seg_halo", F.greatest(F.size("_seg_halo") - n + 1, F.lit(1)), F.greatest(n, F.lit(0))),
                    lambda h: h["v"]), lambda v: v.isNotNull()))
    more = F.when(F.size(missing) > 0, F.aggregate(missing, F.lit(0).cast(dtype), lambda a, v: (a + v).cast(dtype)))
    fixes = {total: F.coalesce(F.col(total) + more, F.col(total), more).cast(dtype),
             count: (F.col(count) + F.greatest(F.coalesce(F.size(missing), F.lit(0)), F.lit(0))).cast("long")}
    return _corrected(local, prior, [*keep, total, count], fixes)


def lag_lead(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[Sort],
             lag: str | None = None, lead: str | None = None,
             max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``lag(value)`` / ``lead(value)`` by one row."""
    schema = df.schema
    keep = [f.name for f in schema.fields]
    w = _window(_with_tie(order))
    cols: dict[str, Column] = {"_seg_at": F.row_number().over(w)}
    per: dict[str, Column] = {}
    carry: list[Column] = []
    fixes: dict[str, Column] = {}
    by_segment, _ = _earlier()
    if lag:
        cols[lag] = F.lag(value).over(w)
        per["_last"] = F.max_by(F.col(value), F.col("_seg_at"))
        carry.append(F.lag("_last").over(by_segment).alias("_seg_prev_last"))
        fixes[lag] = F.when(F.col("_seg_at") == 1, F.col("_seg_prev_last")).otherwise(F.col(lag))
    if lead:
        cols[lead] = F.lead(value).over(w)
        cols["_seg_is_last"] = F.lead(F.lit(1)).over(w).isNull()
        per["_first"] = F.min_by(F.col(value), F.col("_seg_at"))
        carry.append(F.lead("_first").over(by_segment).alias("_seg_next_first"))
        fixes[lead] = F.when(F.col("_seg_is_last"), F.col("_seg_next_first")).otherwise(F.col(lead))
    local = _segments(df, schema, partition, order, max_rows, rows).withColumns(cols)
    prior = _per_segment(local, per).select(GK, SEG, *carry)
    return _corrected(local, prior, [*keep, *fixes], fixes)


def rank_by_key(df: DataFrame, partition: Sequence[str], order: Sequence[Sort], out: str,
                max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``rank()`` computed from key counts, for heavily tied keys.

    rank(key) = 1 + number of rows with an earlier key.  Rows are first
    counted per distinct (group, key) (map-side partial aggregation absorbs
    hot keys), the counts are summed in order with :func:`running_sum`, and
    ranks are joined back on the whole key as one struct (NULL fields
    compare equal)."""
    keys = [*partition, *[s.col for s in order]]
    keep = df.columns
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    before = running_sum(counts, "_c", partition, order, "_before", exclusive=True,
                         max_rows=max_rows, rows=rows)
    ranks = before.select(F.struct(*keys).alias("_rk"),
                          (F.coalesce(F.col("_before"), F.lit(0)) + 1).cast("long").alias(out))
    return (df.withColumn("_rk", F.struct(*keys)).join(ranks, "_rk")
            .select(*[F.col(c) for c in keep], F.col(out)))
