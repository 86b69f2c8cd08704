"""Prefix trie of conversations, by collapsing whole sequences.

``turns`` numbers the rows of each conversation.  ``rebuild`` gives every
conversation the first turns of its block's first conversation.  ``paths``
adds to each turn the key of the sequence up to it: a running sum of 92-bit
hashes of (position, turn), so equal prefixes have equal keys and the running
sums of :mod:`souk.operators.ordered` may split a long conversation.  ``trie``
then collapses identical conversations into sequences:

* ``sequences``: conversations grouped by their last key, each a weight, a
  smallest member and a digest of its end list;
* only the smallest member's turns go on, so the work grows with distinct
  sequences; an anti-join against the keys inside other sequences leaves the
  leaves;
* one aggregation by prefix key of these weighted turns gives every node its
  members, leaves and tokens.  Partial aggregation absorbs common prefixes.

Tokens saved in a subtree are the sum over its nodes of (members - 1) x words.
The members' part is a sum over sequences of weight x words from this depth
on.  The rest, each distinct node's words once, is summed over leaves too:
every node belongs to the smallest leaf below it, so what a leaf owns is the
lower end of its path, and its words count for all nodes above.

End lists may be as long as the table: ids are joined to chunks in ranges of
(sequence, id), and one pass over a sequence's chunks in order feeds SHA-256,
so no list is ever whole in memory.

Defined results: an empty table gives no rows; rows without an id belong to no
conversation and are left out; a NULL turn comes first; rows of one turn are
ordered by the SHA-256 of role and text (repeated rows are repeated turns);
NULL role or text is empty; texts count whole, of any length; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.shared import stage
from souk.operators.ordered import asc, rank_within, running_sums

BLOCK = 20
WORD = r"[^\x20\x09-\x0D]+"
#: Ids joined to one chunk of an end list.
CHUNK_IDS = 512
_KEY = "decimal(38,0)"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _crc(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary"))


def turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", max_rows: int | None = None) -> DataFrame:
    """(conv, place from 1, turn hash, words) of every row with an id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    known = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        # the role's length keeps (role, text) pairs apart
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    known = stage(known, "trie-rows")       # the texts are read once, and the count is known
    return rank_within(known, ["conv"], [asc("turn"), asc("hash")], "place", "row_number", max_rows,
                       known.count()).drop("turn")


def rebuild(numbered: DataFrame, heads: Column, most: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(conversations, their rebuilt turns): each conversation ``conv`` takes
    the first ``heads`` (an expression of ``conv``, ``most`` at most) turns of
    the first conversation of its block, then its own turns after as many."""
    base = (F.col("conv") - F.col("conv") % block).alias("base")
    firsts = (numbered.where((F.col("place") <= most) & (F.col("conv") % block == 0))
              .select(F.col("conv").alias("base"), "place", "hash", "words"))
    convs = numbered.where(F.col("place") == 1).select("conv", heads.cast("long").alias("heads"), base)
    shared = (convs.join(firsts, "base").where(F.col("place") <= F.col("heads"))
              .select("conv", F.col("place").alias("depth"), "hash", "words"))
    there = firsts.groupBy("base").agg(F.max("place").alias("there"))
    own = (numbered.withColumns({"heads": heads.cast("long"), "base": base})
           .where(F.col("place") > F.col("heads")).join(there, "base", "left")
           .select("conv", (F.col("place") - F.col("heads") + F.least("heads", F.coalesce("there", F.lit(0))))
                   .cast("long").alias("depth"), "hash", "words"))
    return convs.select("conv"), shared.unionByName(own)


def paths(rebuilt: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``rebuilt`` with ``key`` and ``parent`` (keys of the sequence up to and
    before the turn) and ``upto`` (its words, this turn included)."""
    at = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "hash").cast("binary"), 256)
    number = lambda start, digits: F.conv(F.substring(at, start, digits), 16, 10).cast("decimal(20,0)")
    hashed = (number(1, 15) * F.lit(1 << 32).cast("decimal(10,0)") + number(16, 8)).cast("decimal(28,0)")
    rebuilt = stage(rebuilt.select("conv", "depth", "words", hashed.alias("h")), "trie-rebuilt")
    summed = running_sums(rebuilt, {"key": "h", "upto": "words"}, ["conv"], [asc("depth")], max_rows=max_rows,
                          rows=rebuilt.count())
    return summed.select("conv", "depth", "words", F.col("key").cast(_KEY).alias("key"),
                         (F.col("key") - F.col("h")).cast(_KEY).alias("parent"), "upto")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, key, conv) to pieces (depth, key, first, ids): the ids of
    one sequence comma-joined, ``CHUNK_IDS`` at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        depth, key, conv = batch.columns
        new = pc.or_(pc.not_equal(depth.slice(1), depth.slice(0, n - 1)),
                     pc.not_equal(key.slice(1), key.slice(0, n - 1))).to_pylist()
        starts = [0] + [i + 1 for i, changed in enumerate(new) if changed] + [n]
        cuts = [c for a, b in zip(starts, starts[1:]) for c in range(a, b, CHUNK_IDS)]
        ids = conv.cast(pa.string()).to_pylist()
        joined = [",".join(ids[a:b]) for a, b in zip(cuts, [*cuts[1:], n])]
        yield pa.RecordBatch.from_arrays([depth.take(cuts), key.take(cuts), conv.take(cuts), pa.array(joined)],
                                         names=["depth", "key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to (depth, key, ends_sha256), one hash state at a time."""
    at, state = None, None
    kind = pa.schema([("depth", pa.int64()), ("key", pa.decimal128(38, 0)), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for depth, key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, key) != at:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = (depth, key), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
    if at is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*at, state.hexdigest()), kind)], schema=kind)


def end_digests(ends: DataFrame) -> DataFrame:
    """Per (depth, key): SHA-256 of the ascending ids ``conv``, comma-joined."""
    by = ["depth", "key", "conv"]
    pieces = (ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
              .mapInArrow(_chunks, f"depth long, key {_KEY}, first long, ids string"))
    return (pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "first")
            .mapInArrow(_digests, f"depth long, key {_KEY}, ends_sha256 string"))


def trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """Nodes of the trie of the conversations ``convs`` with turns ``steps``
    (see :func:`paths`): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    zero = F.lit(0).cast("long")
    none = F.lit(0).cast(_KEY)
    last = steps.groupBy("conv").agg(F.max("depth").alias("depth"), F.max_by("key", "depth").alias("key"),
                                     F.max("upto").alias("total"))
    ends = stage(convs.join(last, "conv", "left").select(
        "conv", F.coalesce("depth", zero).alias("depth"), F.coalesce("key", none).alias("key"),
        F.coalesce("total", zero).alias("total")), "trie-ends")
    sequences = ends.groupBy("depth", "key").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total"))

    # the turns of one conversation for each sequence, and the root above them
    chosen = sequences.select("conv", F.col("depth").alias("length"), "weight", "total")
    inner = steps.join(chosen, "conv")
    top = chosen.select("conv", zero.alias("depth"), zero.alias("words"), none.alias("key"),
                        F.lit(None).cast(_KEY).alias("parent"), zero.alias("upto"), "length", "weight", "total")
    within = inner.unionByName(top).where(F.col("depth") < F.col("length")).select("depth", "key").distinct()
    leaves = sequences.join(within, ["depth", "key"], "left_anti").select("conv", F.lit(True).alias("leaf"))
    walk = stage(inner.unionByName(top).join(leaves, "conv", "left").select(
        "conv", "depth", "key", "parent", "words", "weight", "leaf",
        (F.col("total") - F.col("upto") + F.col("words")).alias("below")), "trie-walk")

    # below: words from this turn to the end of the sequence
    nodes = stage(walk.groupBy("depth", "key").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"), F.sum(F.col("weight") * F.col("below")).alias("read"),
        F.min(F.struct(F.when(F.col("leaf"), F.col("conv")).isNull().alias("no"), F.col("conv"), F.col("below")))
        .alias("owner")), "trie-nodes")
    # what each leaf owns starts where its path leaves those of smaller leaves
    owned = nodes.groupBy(F.col("owner.conv").alias("conv")).agg(F.max("owner.below").alias("owned"))
    once = (walk.where("leaf").join(owned, "conv").groupBy("depth", "key").agg(F.sum("owned").alias("owned")))
    owner_owned = owned.select(F.col("conv").alias("owner_conv"), F.col("owned").alias("owner_owned"))
    children = (nodes.where(F.col("parent").isNotNull())
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"),
                           F.col("conv_id").alias("parent_conv_id"))
    listed = end_digests(ends)
    return (nodes.join(once, ["depth", "key"]).join(children, ["depth", "key"], "left")
            .join(listed, ["depth", "key"], "left").join(parents, ["depth", "parent"], "left")
            .join(owner_owned, F.col("owner.conv") == F.col("owner_conv"))
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
                    (F.col("read") - (F.col("owned") - F.col("owner_owned") + F.col("owner.below")))
                    .alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))
