"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal arcs.  Every shard owns ``vnodes`` of them by
hash; a row belongs to the next virtual node clockwise from its own hash.
A shard takes rows of its own arcs, in ring order, up to its capacity; what
overflows goes on clockwise to the next virtual node whose shard has room.

Only the row count of each cell (at most ``cells`` rows) reaches the driver,
where the walk round the ring is worked out.  Rows are then placed by their
rank in their cell.  All row work is DataFrame functions.

Null, empty and repeated values: a null text has size 1 and the CRC of an
empty text; a null id hashes like any other value; repeated rows are separate
rows and share a cell.  An empty table gives an empty result.  Other columns
of the input are not read.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Mapping

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.shared import stage

CELLS = 1 << 14
VNODES = 64
_PLAN = "array<struct<cell:int,lo:bigint,hi:bigint,shard:int,base:bigint>>"


def ring(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """Virtual nodes as (cell, shard) in ring order.  Two on one cell: the
    later one moves clockwise to the next free cell."""
    if shards * vnodes > cells:
        raise ValueError("more virtual nodes than cells")
    taken: dict[int, int] = {}
    for v in range(vnodes):
        for s in range(shards):
            cell = xxhash.xxh64_intdigest(f"shard {s} node {v}") % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = s
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may hold.  Without slack they add up to ``rows`` and
    differ by one at most; with slack each is the mean times 1 + slack."""
    if slack > 0:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(counts: Mapping[int, int], shards: int, vnodes: int = VNODES, cells: int = CELLS,
          slack: float = 0.0) -> list[dict]:
    """The walk: which ranks of which cell go to which shard, from which slot
    on.  ``counts``: rows by cell."""
    nodes = ring(shards, vnodes, cells)
    room = capacities(sum(counts.values()), shards, slack)
    filled = [0] * shards
    out: list[dict] = []
    over: dict[int, list[tuple[int, int, int]]] = {}  # by index of the node

    def put(shard: int, cell: int, lo: int, hi: int) -> None:
        out.append({"cell": cell, "lo": lo, "hi": hi, "shard": shard, "base": filled[shard]})
        filled[shard] += hi - lo
        room[shard] -= hi - lo

    at = 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        node = at % len(nodes)
        shard, n = nodes[node][1], counts[cell]
        own = min(n, room[shard])
        if own:
            put(shard, cell, 0, own)
        if own < n:
            over.setdefault(node, []).append((cell, own, n))
    carry: deque[tuple[int, int, int]] = deque()
    for k in range(2 * len(nodes)):
        shard = nodes[k % len(nodes)][1]
        while carry and room[shard]:
            cell, lo, hi = carry.popleft()
            own = min(hi - lo, room[shard])
            put(shard, cell, lo, lo + own)
            if lo + own < hi:
                carry.appendleft((cell, lo + own, hi))
        carry.extend(over.pop(k % len(nodes), ()))
        if not carry and not over:
            break
    return out


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
           vnodes: int = VNODES, cells: int = CELLS, slack: float = 0.0) -> DataFrame:
    """Shard and slot of every row: (id, size, text_crc32, shard, slot).
    Slots of a shard are 0, 1, 2, ... without gaps."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    place_of = F.xxhash64("id", "text_crc32", "size")
    rows = stage(rows.withColumn("at", place_of)
                 .withColumn("cell", F.pmod("at", F.lit(cells)).cast("int")), "ring")
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # cells rows at most
    plan = json.dumps(place(counts, shards, vnodes, cells, slack))
    segments = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(plan), _PLAN)))
    in_cell = Window.partitionBy("cell").orderBy("at", "id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(in_cell).cast("long") - 1)
    # Bounded: a segment for each cell, and one more wherever a shard fills up.
    return (
        ranked.join(F.broadcast(segments), "cell")
        .where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))
    )
