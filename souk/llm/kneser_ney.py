"""Language-model scoring: an interpolated modified Kneser-Ney bigram model,
counted in Spark, kept as sorted hash arrays and memory-mapped by workers.

Words are runs without white space, A-Z as a-z; each text ends with an end
token, and its first word's context is a start mark.

Building, all by hash shards whose size is bounded:
1. Word counts: tasks count blocks of text, shards add them up.
2. A word that holds more than a quarter of a shard's share of all tokens is
   frequent, which its count in the files tells, so no list of such words is
   made; its bigrams are dealt by the pair, all others by the first word.
3. Bigram counts: blocks, then shards.  A shard writes its sorted array (56
   bits of hash and 8 of count; counts from 255 on are in a small array beside
   it) and passes on, for each word, how many words follow and precede it.
4. Word shards merge those and write one sorted record per word.

Every shard file is written under a temporary name and moved into place, so a
task that runs again leaves the same file.  Scoring maps the files and looks up
the distinct words and pairs of a slice of texts at once.  A worker keeps a
bounded number of files mapped, and a mapped file holds no descriptor.

Null texts count as empty: one end token.  Without training rows all counts
are zero and every token has the probability of an unknown word.  Repeated
rows count as often as they occur.  Only the named columns are read.
"""

from __future__ import annotations

import io
import json
import mmap
import os
import sys
import tempfile
from collections import OrderedDict, defaultdict
from collections.abc import Iterator
from itertools import count
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from souk.llm.shared import slices, utf8, workspace

#: Tokens that a task counts before it passes the counts on, and about as
#: many that a shard takes.
BLOCK_TOKENS = 4_000_000
SHARD_TOKENS = 2_000_000
_HEAVY = 4  # a word is frequent from a 1/4 of a shard's share on
# Before Python 3.13 every map holds a descriptor.
_NO_DESCRIPTOR = {"trackfd": False} if sys.version_info >= (3, 13) else {}
_MAPS = 16_000 if _NO_DESCRIPTOR else 200
_LOW = np.uint64(0xFF)
_HASH = ~_LOW
_START, _END = 0, 1  # local numbers
_START_HASH, _END_HASH = xxhash.xxh64_intdigest(b"\n<s>"), xxhash.xxh64_intdigest(b"\n</s>")
_COUNT = np.dtype([("key", "<u8"), ("c", "<u8")])
_WORD = np.dtype([("key", "<u8"), ("c", "<u8"), ("before", "<u4"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return pafs.LocalFileSystem(), url.path
    return pafs.FileSystem.from_uri(path)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    raw = io.BytesIO()
    np.save(raw, array)
    part = f"{root}/.{name}-{os.urandom(8).hex()}"
    with fs.open_output_stream(part) as out:
        out.write(raw.getbuffer())
    fs.move(part, f"{root}/{name}.npy")


def _mapped(path: str) -> np.ndarray:
    with open(path, "rb") as file:
        np.lib.format.read_magic(file)
        shape, _, kind = np.lib.format.read_array_header_1_0(file)
        whole = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **_NO_DESCRIPTOR)
        return np.ndarray(shape, kind, whole, file.tell())


def _open(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped.  A file in a store that cannot be mapped is
    copied once and unlinked as soon as it is mapped."""
    fs, root = _file_system(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return _mapped(f"{root}/{name}.npy")
    with tempfile.NamedTemporaryFile(suffix=".npy") as copy:
        with fs.open_input_stream(f"{root}/{name}.npy") as source:
            while chunk := source.read(1 << 24):
                copy.write(chunk)
        copy.flush()
        return _mapped(copy.name)


def _present(folder: str, name: str) -> np.ndarray | None:
    try:
        return _open(folder, name)
    except FileNotFoundError:  # nothing of this shard occurs
        return None


class _Files:
    """A folder's arrays, mapped when asked for; the ``limit`` last used stay
    mapped."""

    def __init__(self, folder: str, limit: int = _MAPS):
        self.folder, self.limit = folder, limit
        self.kept: OrderedDict[str, np.ndarray | None] = OrderedDict()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"kept": OrderedDict()}

    def __getitem__(self, name: str) -> np.ndarray | None:
        if name not in self.kept:
            self.kept[name] = _present(self.folder, name)
            if len(self.kept) > self.limit:
                self.kept.popitem(last=False)
        self.kept.move_to_end(name)
        return self.kept[name]

    def records(self, kind: str, form: np.dtype, keys: np.ndarray, shards: int) -> np.ndarray:
        """Each key's record in the shards named ``kind``, zero where there is
        none."""
        out = np.zeros(len(keys), form)
        for s, at in _dealt(_shard(keys, shards), np.argsort(keys)):
            table = self[f"{kind}-{s}"]
            if table is not None and len(table):
                found = table[np.minimum(np.searchsorted(table["key"], keys[at]), len(table) - 1)]
                hit = found["key"] == keys[at]
                out[at[hit]] = found[hit]
        return out


def mix(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of hashes."""
    with np.errstate(over="ignore"):
        h = (v ^ (v >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _heavy(c: np.ndarray, tokens: int, shards: int) -> np.ndarray:
    """Which words, by their counts, are frequent."""
    return c.astype(float) * (_HEAVY * shards) > tokens


def _pair_shard(v: np.ndarray, pair: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    return _shard(np.where(heavy, pair, mix(v, v)), shards)


class _Block:
    """Texts as local word numbers."""

    def __init__(self) -> None:
        self.local: dict[bytes, int] = defaultdict(count(2).__next__)
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        flat: list[int] = []
        for text in texts:
            flat.append(_START)
            flat.extend(map(self.local.__getitem__, text.lower().split()))
            flat.append(_END)
        self.tokens.append(np.array(flat, np.int64))
        self.size += len(flat)

    def hashes(self) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        return np.array([_START_HASH, _END_HASH, *[digest(w) for w in self.local]], np.uint64)

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for part in slices(batches, "text"):
        block.add(utf8(part.column("text")))
        if block.size >= BLOCK_TOKENS:
            yield block
            block = _Block()
    if block.size:
        yield block


def _small(n: np.ndarray) -> bytes:
    """Counts as bytes, if they fit, else as 32-bit numbers."""
    return (n.astype(np.uint8) if not len(n) or n.max() < 256 else n.astype(np.uint32)).tobytes()


def _large(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if len(raw) == size else np.uint32).astype(np.int64)


def _dealt(shard: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and its places, in ``order``."""
    order = order[np.argsort(shard[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            yield int(shard[at[0]]), at


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of their values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return (key[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values])


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    shard, *rest = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *[pa.array(x, pa.binary()) for x in rest]],
                                      ["shard", "a", "b", "n"])


_BLOB = "shard int, a binary, b binary, n binary"


def _count_words(rows: DataFrame, folder: str, shards: int) -> int:
    """Write every word shard's counts; the number of tokens."""
    def count_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            keys, n = block.hashes(), np.bincount(block.numbers(), minlength=len(block.local) + 2)
            yield _blobs([(s, keys[at].tobytes(), b"", _small(n[at]))
                          for s, at in _dealt(_shard(keys, shards), np.argsort(keys)) if n[at].any()])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, np.uint64) for x in group["a"]]
        n = [_large(x, len(k)) for x, k in zip(group["n"], keys)]
        key, total = _sums(np.concatenate(keys), np.concatenate(n))
        out = np.zeros(len(key), _COUNT)
        out["key"], out["c"] = key, total
        _save(folder, f"count-{group['shard'].iloc[0]}", out)
        start = total[key == np.uint64(_START_HASH)].sum()
        return pd.DataFrame({"tokens": [int(total.sum() - start)]})

    return (rows.mapInArrow(count_block, _BLOB).groupBy("shard").applyInPandas(merge, "tokens bigint")
            .agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])


def _count_pairs(rows: DataFrame, folder: str, shards: int, tokens: int) -> Row:
    """Write the bigram arrays and the word records; sums over each word
    shard."""
    def count_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for block in _blocks(batches):
            t, keys = block.numbers(), block.hashes()
            block.tokens.clear()
            heavy = _heavy(files.records("count", _COUNT, keys, shards)["c"], tokens, shards)
            within = t[:-1] != _END
            pair, n = np.unique(t[:-1][within] << 32 | t[1:][within], return_counts=True)
            v, w = keys[pair >> 32], keys[pair & 0xFFFFFFFF]
            shard = _pair_shard(v, mix(v, w), heavy[pair >> 32], shards)
            rows = []
            # Local numbers keep pairs of one first word together.
            for s, at in _dealt(shard, np.arange(len(pair))):
                first = np.flatnonzero(np.concatenate(([True], pair[at][1:] >> 32 != pair[at][:-1] >> 32)))
                runs = np.diff(np.append(first, len(at)))
                head = np.concatenate((np.array([len(first)], np.uint64), v[at][first])).tobytes()
                rows.append((s, head + runs.astype(np.uint32).tobytes(), w[at].tobytes(), _small(n[at])))
            yield _blobs(rows)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        vs, ws, ns = [], [], []
        for a, b, n in zip(group["a"], group["b"], group["n"]):
            size = int(np.frombuffer(a, np.uint64, 1)[0])
            vs.append(np.repeat(np.frombuffer(a, np.uint64, size, 8), np.frombuffer(a, np.uint32, size, 8 + 8 * size)))
            ws.append(np.frombuffer(b, np.uint64))
            ns.append(_large(n, len(ws[-1])))
        s = int(group["shard"].iloc[0])
        v, w, n = np.concatenate(vs), np.concatenate(ws), np.concatenate(ns)
        del vs, ws, ns
        order = np.lexsort((w, v))
        v, w, n = v[order], w[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
        v, w, n = v[first], w[first], np.add.reduceat(n, first)
        key = mix(v, w) & _HASH
        order = np.argsort(key)
        packed = key[order] | np.minimum(n[order], 255).astype(np.uint64)
        big = order[n[order] >= 255]
        _save(folder, f"pair-{s}", packed)
        _save(folder, f"many-{s}", np.array(list(zip(key[big].tolist(), n[big].tolist())), [("key", "<u8"), ("n", "<u8")]))
        out = []
        after, *kinds = _sums(v, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64))
        word, before = _sums(w, np.ones(len(w), np.int64))
        for t, at in _dealt(_shard(after, shards), np.arange(len(after))):
            out.append((t, after[at].tobytes(), b"v", np.stack([k[at] for k in kinds]).astype(np.uint32).tobytes()))
        for t, at in _dealt(_shard(word, shards), np.arange(len(word))):
            out.append((t, word[at].tobytes(), b"w", _small(before[at])))
        return pd.DataFrame(out, columns=["shard", "a", "b", "n"])

    def records(group: pd.DataFrame) -> pd.DataFrame:
        s = int(group["shard"].iloc[0])
        counts = _open(folder, f"count-{s}")
        keys = counts["key"].copy()
        out = np.zeros(len(counts), _WORD)
        out["key"], out["c"] = counts["key"], counts["c"]
        for a, b, n in zip(group["a"], group["b"], group["n"]):
            at = np.searchsorted(keys, np.frombuffer(a, np.uint64))
            if b == b"w":
                out["before"][at] += _large(n, len(at)).astype(np.uint32)
            else:
                for name, x in zip(("n1", "n2", "n3"), np.frombuffer(n, np.uint32).reshape(3, -1)):
                    out[name][at] += x
        _save(folder, f"word-{s}", out)
        real = out[out["key"] != np.uint64(_START_HASH)]
        few = [int((real["before"] == i).sum()) for i in (1, 2, 3, 4)]
        return pd.DataFrame([[len(real), int(real["before"].sum()), *few]], columns=["v", "pairs", "k1", "k2", "k3", "k4"])

    blobs = rows.mapInArrow(count_block, _BLOB).groupBy("shard").applyInPandas(merge, _BLOB)
    return (blobs.groupBy("shard").applyInPandas(records, "v bigint, pairs bigint, k1 bigint, k2 bigint, k3 bigint, k4 bigint")
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("v", "pairs", "k1", "k2", "k3", "k4")]).first())


def _count_of_counts(spark: SparkSession, folder: str, shards: int) -> list[int]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column("id").to_pylist():
                pairs = _present(folder, f"pair-{s}")
                if pairs is not None:
                    n = np.zeros(256, np.int64)
                    for at in range(0, len(pairs), 1 << 20):
                        n += np.bincount((pairs[at:at + (1 << 20)] & _LOW).astype(np.int64), minlength=256)
                    yield pa.RecordBatch.from_arrays([pa.array([int(n[i])]) for i in (1, 2, 3, 4)], ["k1", "k2", "k3", "k4"])

    row = spark.range(0, shards, 1, min(shards, max(64, shards // 64))).mapInArrow(look, "k1 bigint, k2 bigint, k3 bigint, k4 bigint").agg(
        *[F.coalesce(F.sum(f"k{i}"), F.lit(0)) for i in (1, 2, 3, 4)]).first()
    return list(row)


def discounts(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of items seen 1, 2, 3 and 4 times.
    Where those leave a discount undefined it is zero times that count's
    share, that is, the count itself is given up whole (D_i = i)."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.0), i) if n[i - 1] else float(i) for i in (1, 2, 3)]


class Model:
    """A built model: its folder and a few sums.  Workers map the files."""

    def __init__(self, folder: str, shards: int, tokens: int, sums: dict):
        self.shards, self.tokens, self.sums = shards, tokens, sums
        self.files = _Files(folder)

    def words(self, keys: np.ndarray) -> np.ndarray:
        """Records of the words, zero where a word is unknown."""
        return self.files.records("word", _WORD, keys, self.shards)

    def pairs(self, v: np.ndarray, w: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Counts of the pairs; ``c``: the counts of their first words."""
        full = mix(v, w)
        key = full & _HASH
        out = np.zeros(len(v), np.int64)
        for s, at in _dealt(_pair_shard(v, full, _heavy(c, self.tokens, self.shards), self.shards), np.argsort(key)):
            table = self.files[f"pair-{s}"]
            if table is None or not len(table):
                continue
            found = table[np.minimum(np.searchsorted(table, key[at]), len(table) - 1)]
            n = np.where(found & _HASH == key[at], found & _LOW, np.uint64(0)).astype(np.int64)
            if (n == 255).any():
                many = self.files[f"many-{s}"]
                big = n == 255
                n[big] = many["n"][np.searchsorted(many["key"], key[at][big])]
            out[at] = n
        return out

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and model score of each text."""
        block = _Block()
        block.add(texts)
        t, keys = block.numbers(), block.hashes()
        words = self.words(keys)
        c = words["c"].astype(float)
        real = t != _START
        doc = np.cumsum(~real) - 1
        total = lambda x: np.bincount(doc[real], x[real], len(texts))
        s = self.sums
        c[_START] = 0
        base = np.log10((c + 1) / (self.tokens + s["v"] + 1))
        d2 = np.array([0.0, *discounts(s["pair_kinds"])])
        d1 = np.array([0.0, *discounts(s["word_kinds"])])
        a = words["before"].astype(float)
        kinds = s["word_kinds"]
        given = d1[1] * kinds[0] + d1[2] * kinds[1] + d1[3] * (s["v"] - kinds[0] - kinds[1])
        if s["pairs"]:
            low = (a - d1[np.minimum(words["before"], 3)]) / s["pairs"] + given / s["pairs"] / (s["v"] + 1)
        else:
            low = np.ones(len(a))
        pair, back = np.unique(np.where(real[1:], t[:-1] << 32 | t[1:], 0), return_inverse=True)
        v, w = pair >> 32, pair & 0xFFFFFFFF
        n = self.pairs(keys[v], keys[w], words["c"][v])
        seen = words["c"][v].astype(float)  # of the start mark: texts
        left = d2[1] * words["n1"][v] + d2[2] * words["n2"][v] + d2[3] * words["n3"][v]
        p = np.where(seen > 0, (n - d2[np.minimum(n, 3)] + left * low[w]) / np.maximum(seen, 1), low[w])
        with np.errstate(divide="ignore"):  # of places between two texts
            logs = np.concatenate(([0.0], np.log10(p)[back])) if len(t) else np.zeros(0)
        return (total(np.ones(len(t))).astype(np.int64), total((c > 0)[t].astype(float)).astype(np.int64),
                total(base[t]), total(logs))


def fit(rows: DataFrame, text_col: str = "text", shards: int | None = None) -> Model:
    """Count all ``rows``.  ``shards`` defaults to the text bytes over about
    ``SHARD_TOKENS`` words of 8 bytes, 16 at least."""
    spark = rows.sparkSession
    rows = rows.select(F.col(text_col).cast("string").alias("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(16, -(-size // (8 * SHARD_TOKENS)))
    folder = workspace(spark, "kneser-ney")
    tokens = _count_words(rows, folder, shards)
    totals = _count_pairs(rows, folder, shards, tokens)
    sums = {"v": totals["v"], "pairs": totals["pairs"], "word_kinds": [totals[f"k{i}"] for i in (1, 2, 3, 4)],
            "pair_kinds": _count_of_counts(spark, folder, shards)}
    return Model(folder, shards, tokens, json.loads(json.dumps(sums)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) for every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n, known, base, logs = model.score(utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens, np.int64)),
                 pa.array(base), pa.array(logs), pa.array(10 ** (-logs / n))],
                ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return (source.mapInArrow(run, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
                                   "score double, perplexity double").withColumnRenamed("id", id_col))
