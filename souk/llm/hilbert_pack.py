"""Packing along a space-filling curve.

A text's byte 4-grams are hashed into a vector, the vector is projected to a
few dimensions by a fixed random matrix, and its place on a Hilbert curve
through that space is the sort key, so similar texts lie close together.  Rows
are range-partitioned and sorted by the key; each partition writes its tokens
one after the other into sequences of ``length``, cutting documents at the
ends of sequences.  Only a partition's last sequence is not full.

Null and empty texts consist of the end id alone.  Equal texts have equal keys
and are ordered by id, then by text hash, so a large group of copies is split
between partitions.  Repeated rows are separate documents.  An empty table
gives an empty result.  Columns other than id and text are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from souk.llm.shared import slices

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS, BUCKETS = 3, 10, 1024
_BLOCK = 1 << 20
#: Sequences of partition p are numbered from p << 40.
PARTITION_SHIFT = 40


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (row of ``bits``-bit coordinates) on the curve, by
    the transpose method: undo the rotations from the top bit down, take the
    Gray code, then interleave the coordinates' bits."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(d):
            turn = (x[i] & q) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(turn, q - 1, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[d - 1] & q, q - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def vector(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed byte 4-gram counts of the whole text, of length one."""
    total = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    for at in range(0, max(len(text) - 3, 0), _BLOCK):
        n = min(_BLOCK + 3, len(text) - at)
        code = np.concatenate([np.frombuffer(text, "<u4", (n - k) // 4, at + k) for k in range(min(4, n - 3))])
        total += np.bincount((code * np.uint32(2654435761)) >> shift, minlength=buckets)
    return total / max(np.sqrt((total.astype(float) ** 2).sum()), 1.0)


def projection(buckets: int = BUCKETS, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((buckets, dimensions))


def curve_keys(texts: list[bytes], matrix: np.ndarray, bits: int = BITS) -> np.ndarray:
    if not texts:
        return np.zeros(0, np.int64)
    where = np.stack([vector(t, matrix.shape[0]) for t in texts]) @ matrix
    # A projected unit vector has standard deviation one or less.
    return hilbert(np.clip((where + 4) / 8 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64), bits)


def _alphabet() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: a
    printable one itself, the others numbered from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in shown)
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Every entry's bytes and id, if merging the neighbours whose joined
    bytes have the lowest id is the same as merging by the vocabulary's list.

    It is for byte-level vocabularies whose ids ascend in the order of the
    merges and whose entries are all their own encoding: neighbours that
    together are an entry, and that no merge has crossed, stand as they do
    when the entry is encoded alone, and alone they end as that entry."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
            or not cut.get("use_regex", True) or any(whole.get(k) for k in ("normalizer", "truncation", "padding"))
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                          "byte_fallback", "ignore_merges"))):
        return None
    vocabulary, letters = model["vocab"], _alphabet()
    made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + len(letters) != len(vocabulary) or not letters.keys() <= vocabulary.keys():
        return None
    bpe = Tokenizer.from_file(path).model
    if any([t.id for t in bpe.tokenize(piece)] != [i] for piece, i in vocabulary.items()):
        return None
    return {bytes(map(letters.__getitem__, piece)): i for piece, i in vocabulary.items()}


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, those of the
    tokenizers library for the vocabulary file.

    Where ``byte_ranks`` allows, a text is merged by rank, which takes a
    fraction of the time.  Texts with a long run of white space (the rank
    merger's pattern cannot take those) or an added token's literal, and all
    texts for other vocabularies, go through the library itself."""

    # Fixed value: the pattern of byte-level pre-tokenizers.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    _SPACES = re.compile(r"\s{200}")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = byte_ranks(path)
        self.ranked = ranks and tiktoken.Encoding("ranked", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_library(self, text: str) -> bool:
        return not self.ranked or self._SPACES.search(text) is not None or any(a in text for a in self.added)

    def encode(self, texts: list[str]) -> list[bytes]:
        slow = [t for t in texts if self.by_library(t)]
        ids = {t: e.ids for t, e in zip(slow, self.tokenizer.encode_batch_fast(slow, add_special_tokens=False))}
        return [np.array(ids[t] if t in ids else self.ranked.encode_ordinary(t), "<u4").tobytes() for t in texts]


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of packed sequences: (id, start, length, ids, doc_tokens,
    sequence_id, offset); ``ids`` holds the piece's token ids as little-endian
    unsigned 32-bit numbers.  ``tokenizer``: path of the vocabulary file."""
    matrix = projection()

    @F.arrow_udf("bigint")
    def key(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(iter([pa.RecordBatch.from_arrays([text], ["t"])]), "t"):
            out.append(curve_keys([x.encode() for x in part.column("t").to_pylist()], matrix))
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", key("text"))
    order = ["key", "id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << PARTITION_SHIFT
        offset = 0
        for part in slices(batches, "text"):
            at, starts, lengths, ids, totals, sequences, offsets = [], [], [], [], [], [], []
            for row, raw in enumerate(encoder.encode(part.column("text").to_pylist())):
                raw += end
                n, done = len(raw) // 4, 0
                while done < n:
                    take = min(n - done, length - offset)
                    at.append(row)
                    starts.append(done)
                    lengths.append(take)
                    ids.append(raw[4 * done:4 * (done + take)])
                    totals.append(n)
                    sequences.append(sequence)
                    offsets.append(offset)
                    done += take
                    offset += take
                    if offset == length:
                        sequence, offset = sequence + 1, 0
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(at, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths)],
                 pa.array(ids, pa.binary()), *[pa.array(x, pa.int64()) for x in (totals, sequences, offsets)]],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return (rows.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                 "sequence_id bigint, offset bigint").withColumnRenamed("id", id_col))
