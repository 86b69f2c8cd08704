"""SimHash near-duplicates by multi-index hashing.

Fingerprints: a bit is set if over half of the hashes of the text's word
shingles (repeats included) have it.  Two fingerprints are linked if they
differ in at most ``bits`` places; a group is what links connect.

Search: the 64 bits are cut into ``segments`` parts.  Two fingerprints within
the distance agree in one part up to a small radius (pigeonhole).  Every
distinct fingerprint is filed under its exact parts; it probes the small
Hamming ball round each of its own parts, and the join keeps a pair only if
the complete distance holds.  Equal fingerprints meet once, before the
search, so a large group of copies costs one probe.

Null and empty texts have fingerprint zero and are linked like any other.
Rows with a null id take the group of the fingerprint they have; a group with
no id has a null component.  Repeated rows give repeated results.  An empty
table gives an empty result.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.shared import slices, stage, utf8

SEED = 42
_BLOCK = 1 << 16  # shingles hashed at once


def fingerprint(text: bytes, words: int = 4, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text."""
    parts = text.lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, n)
    first, last = starts[: n - width + 1].tolist(), ends[width - 1:].tolist()
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(first), _BLOCK):
        raw = b"".join([digest(joined[a:b], seed) for a, b in zip(first[i:i + _BLOCK], last[i:i + _BLOCK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 4) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    ids = T.StructField("id", docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fps = np.array([fingerprint(x, words) for x in utf8(part.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, T.StructType([ids, T.StructField("fp", T.LongType())]))


def _parts(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each part of the 64 bits."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _key(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))


def links(distinct: DataFrame, bits: int = 4, segments: int = 3) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``fp`` that
    differ in at most ``bits`` places.  ``segments`` must exceed bits / 2."""
    radius, extra = divmod(bits, segments)
    if radius > 1:
        raise ValueError("more segments are needed: the ball of a part has radius 1 at most")
    # A pair beyond the bound in every part would differ in more than `bits`
    # places, so part i needs radius `radius` for i <= extra, one less after.
    filed, exact, flipped = [], [], []
    for i, (shift, width) in enumerate(_parts(segments)):
        reach = radius if i <= extra else radius - 1
        if reach < 0:
            continue
        key = _key(shift, width)
        filed.append(F.struct(F.lit(i).alias("part"), key.alias("key")))
        exact.append(F.struct(F.lit(i).alias("part"), key.alias("key"), F.lit(True).alias("same")))
        # Of two keys one bit apart one has a 0 there, so only zeros are set.
        flipped += [F.when(key.bitwiseAND(F.lit(1 << b)) == 0, F.struct(
            F.lit(i).alias("part"), key.bitwiseOR(F.lit(1 << b)).alias("key"), F.lit(False).alias("same")))
            for b in range(width if reach else 0)]
    table = distinct.select(F.col("fp").alias("t"), F.inline(F.array(*filed)))
    probes = (distinct.select(F.col("fp").alias("p"), F.explode(F.array(*exact, *flipped)).alias("x"))
              .where("x is not null").select("p", "x.*"))
    near = F.bit_count(F.col("p").bitwiseXOR(F.col("t"))) <= bits
    found = probes.join(table, (probes["part"] == table["part"]) & (probes["key"] == table["key"])
                        & near & (~F.col("same") | (F.col("p") < F.col("t"))))
    return found.select(F.least("p", "t").alias("a"), F.greatest("p", "t").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("low").alias("a"), "b").where("a < b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    joined = edges.join(low, "b")
    turned = joined.select(F.least("a", "low").alias("x"), F.greatest("a", "low").alias("y"))
    return (turned.where("x < y").unionByName(low.select(F.col("low").alias("x"), F.col("b").alias("y")))
            .distinct().select(F.col("x").alias("a"), F.col("y").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node's links reach, for
    nodes with a link.  Large-star and small-star turns until nothing moves;
    each turn starts from staged files."""
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stage(edges, "links")
    seen = mark(edges)
    while seen[0]:
        edges = stage(_small_star(_large_star(edges)), "star")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(roots)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
           bits: int = 4, segments: int = 3) -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest id
    in the row's group."""
    fps = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("lead"))
    found = components(links(distinct.select("fp"), bits, segments))
    rooted = (distinct.join(found, F.col("fp") == F.col("node"), "left")
              .select("fp", "lead", F.coalesce("root", "fp").alias("root")))
    leads = rooted.groupBy("root").agg(F.min("lead").alias("component_id"))
    named = rooted.select("fp", "root").join(leads, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
             bits: int = 4, segments: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, the one with the
    smallest id (then the smallest row hash; equal rows count as one)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(whole, F.lit("row")).alias("row"))
    group = groups(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", words, bits, segments)

    def parts(key: Column) -> list[Column]:
        # plain columns, never null: the join and the removal of equal rows share one shuffle
        return [F.coalesce(F.concat(F.lit("="), key["id"].cast("string")), F.lit("-")).alias("i"), key["row"].alias("h")]

    stay = group.select(*parts(F.col("component_id"))).distinct()
    # the id is part of the key: rows of two ids never stand for each other
    kept = docs.select(*parts(key), whole.alias("whole")).join(stay, ["i", "h"], "left_semi").dropDuplicates(["i", "h"])
    return kept.select(*[F.col("whole")[c].alias(c) for c in docs.columns])
