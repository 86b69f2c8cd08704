"""Top-k, overall or per group.

``ties="cut"`` returns exactly ``k`` rows per group (the caller makes the
order total by appending an id, so the cut is deterministic); ``"rank"``
keeps every row whose ``rank()`` is at most ``k`` (ties at the cut
survive); ``"dense"`` uses ``dense_rank()``.

Plans: an overall cut is ``orderBy().limit(k)``, which Spark runs as
``TakeOrderedAndProject`` (each task keeps its own k rows).  Ranked and
per-group variants are a rank-like window filtered by ``<= k``; Catalyst
turns that into a partial ``WindowGroupLimit`` before the shuffle, so a hot
group sends at most k rows (plus ties) per map task, never the whole group.
Catalyst does so up to k = 1000.  Beyond that a first cut ranks rows within
(group, hash of the row), so a hot group is cut to k rows (plus ties) in each
of its parts before they meet.  The result is the same: a row among the first
k of its group is among the first k of any part of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.operators.ordered import Sort

#: Above this k Spark plans no partial limit (its windowGroupLimitThreshold).
PARTIAL_LIMIT_K = 1000
PARTS = 64
_FUNCS = {"cut": F.row_number, "rank": F.rank, "dense": F.dense_rank}


def top_k(df: DataFrame, order: Sequence[Sort], k: int, partition: Sequence[str] = (),
          ties: str = "cut", rank_col: str | None = None) -> DataFrame:
    """Rows ranked at most ``k`` by ``order`` (per ``partition`` group when given)."""
    if k < 1:
        raise ValueError("k must be at least 1")
    if ties not in _FUNCS:
        raise ValueError(f"ties must be one of {sorted(_FUNCS)}")
    if not partition and ties == "cut" and rank_col is None:
        return df.orderBy(*[s.column() for s in order]).limit(k)
    name = rank_col or "_topk_rank"
    by = [s.column() for s in order]
    if k > PARTIAL_LIMIT_K:
        hashable = [f.name for f in df.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
        part = F.pmod(F.xxhash64(*hashable), F.lit(PARTS))
        local = Window.partitionBy(*partition, "_topk_part").orderBy(*by)
        df = (df.withColumn("_topk_part", part).withColumn("_topk_local", _FUNCS[ties]().over(local))
              .where(F.col("_topk_local") <= k).drop("_topk_part", "_topk_local"))
    w = Window.partitionBy(*partition).orderBy(*by)
    ranked = df.withColumn(name, _FUNCS[ties]().over(w)).where(F.col(name) <= k)
    if rank_col:
        return ranked.withColumn(name, F.col(name).cast("long"))
    return ranked.drop(name)
