"""SentencePiece encoding and decoding with batched numpy Viterbi.

A text becomes units that pieces never cross: a run of spaces with the
characters up to the next space.  Distinct units of about one length, filled up
to the longest of them, advance together, one character place at a time.  For all of them the substrings that
end there are hashed and probed in the sorted hashes of the pieces, and the
best way to reach the place and its last piece are stored as backpointers.

``unigram`` models: the best way has the largest sum of piece scores.
``bpe`` models: merges by rank give a sequence in which every two neighbours
are left alone when encoded by themselves, and only one sequence has that
property; a step from one piece to the next is open only where that holds, so
the one open way is the library's encoding.  The check of two neighbours is
kept in a bounded table.

Characters without a piece become byte pieces (or the unknown piece, if the
model has none).  Units found more than once in a slice of texts are kept with
their ids in two bounded generations: what is used again moves to the newer
one, and the older one is dropped when that is full.  A worker's memory is
bounded by these, the table of pairs, one slice of texts and one batch of
places; decoding takes Spark functions and no worker.  Null texts count as
empty and give no ids.  Repeated rows give repeated results, and an empty table
none; very long units take time in proportion to their length.  Of ways with
one score the first found stays (the shortest last piece).  Columns other than
id and text are not read.

The vocabulary file's path is a parameter; models with a normalisation table
of their own are refused.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.shared import slices

SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNITS, _LONG = 100_000, 64  # bound of each generation of the cache; longer units are not kept
_PAIR_BITS = 21  # the table of pairs has a place for each hash of so many bits, the last pair there stays
_FILTER_BITS = 18  # most substrings are no piece, and a table of this size tells so before the sorted keys are probed
_CELLS = 1 << 18  # places of one batch of units


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, raw[at:at + size]
            at += size


class Pieces:
    """What a model file says: pieces, scores, kind and white-space rules."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = dict(_fields(sp.serialized_model_proto()))
        trainer, rules = dict(_fields(proto.get(2, b""))), dict(_fields(proto.get(3, b"")))
        self.kind = {1: "unigram", 2: "bpe"}.get(trainer.get(3, 1))
        if self.kind is None or rules.get(2):
            raise ValueError("only unigram and bpe models without a normalisation table are read")
        self.prefix, self.trim = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        self.unknown = sp.unk_id()
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in self.text.items()}
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.lowest = min((self.score[i] for i in plain), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece crosses a space")


def _points(units: list[str]) -> np.ndarray:
    """Code points of units, a row each, filled up to the longest with zeros."""
    width = max(map(len, units))
    text = "".join([u.ljust(width, "\0") for u in units])
    return np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(units), -1).astype(np.uint64)


def _batches(sizes: list[int], rows: list[int]) -> Iterator[list[int]]:
    """Rows by size in lists of at most ``_CELLS`` places, or one row."""
    rows = sorted(rows, key=sizes.__getitem__)
    while rows:
        n = max(1, _CELLS // sizes[rows[0]])
        while n > 1 and n * sizes[rows[min(n, len(rows)) - 1]] > _CELLS:
            n = max(1, _CELLS // sizes[rows[min(n, len(rows)) - 1]])
        yield rows[:n]
        rows = rows[n:]


class Encoder:
    def __init__(self, path: str):
        self.model = m = Pieces(path)
        by_length: dict[int, list[str]] = {}
        for p in m.ids:
            by_length.setdefault(len(p), []).append(p)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, pieces in by_length.items():
            keys = np.zeros(len(pieces), np.uint64)
            for c in _points(pieces).T:
                keys = keys * _BASE + c
            order = np.argsort(keys)
            maybe = np.zeros(1 << _FILTER_BITS, bool)
            maybe[self._slot(keys)] = True
            self.tables[size] = keys[order], np.array([m.ids[p] for p in pieces])[order], maybe
            if (np.diff(self.tables[size][0]) == 0).any():
                raise ValueError("two pieces have one hash")
        self.powers = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(m.longest + 1)]
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.apart = np.full(1 << _PAIR_BITS, -1, np.int64)
        self.ends: dict[int, tuple[list[float], list[str], list[str], bool]] = {}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys ^ keys >> np.uint64(29)) * _BASE >> np.uint64(64 - _FILTER_BITS)

    @staticmethod
    def _place(pairs: np.ndarray) -> np.ndarray:
        keys = pairs.view(np.uint64)
        return (keys ^ keys >> np.uint64(31)) * _BASE >> np.uint64(64 - _PAIR_BITS)

    def _ends(self, piece: int) -> tuple[list[float], list[str], list[str], bool]:
        """How a piece comes about by merges by score, leftmost first: the
        score of each merge, the first and the last part before each merge and
        at the end, and whether one part is left."""
        parts, scores = list(self.model.text[piece]), []
        first, last = [parts[0]], [parts[-1]]
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = self.model.ids.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.model.score[j] > best):
                    best, at = self.model.score[j], i
            if best is None:
                return scores, first, last, len(parts) == 1
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            scores.append(float(best))
            first.append(parts[0])
            last.append(parts[-1])

    def _left_alone(self, a: int, b: int) -> bool:
        """Whether merging the two pieces' characters gives the two pieces:
        each comes about by its own merges, in order of score, and no merge
        across the border comes before theirs end."""
        if a not in self.ends:
            self.ends[a] = self._ends(a)
        if b not in self.ends:
            self.ends[b] = self._ends(b)
        left, _, tail, one = self.ends[a]
        right, head, _, other = self.ends[b]
        if not (one and other):
            return False
        ids, score = self.model.ids, self.model.score
        i = j = 0
        while True:
            over = ids.get(tail[i] + head[j])
            x = left[i] if i < len(left) else None
            y = right[j] if j < len(right) else None
            if over is not None:
                # on equal scores the leftmost merge comes first
                c = score[over]
                if (x is None or c > x) and (y is None or c >= y):
                    return False
            if x is None and y is None:
                return True
            if y is None or (x is not None and x >= y):
                i += 1
            else:
                j += 1

    def _open(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each two neighbouring pieces are left alone by merging."""
        pair = (before.astype(np.int64) << 32 | piece) << 1  # the lowest bit of an entry is the answer
        entry = self.apart[self._place(pair)]
        out = (entry & 1).astype(bool)
        new = entry & -2 != pair
        if new.any():
            pairs, back = np.unique(pair[new], return_inverse=True)
            found = np.array([self._left_alone(p >> 33, p >> 1 & 0xFFFFFFFF) for p in pairs.tolist()], bool)
            out[new] = found[back]
            self.apart[self._place(pairs)] = pairs | found
        return out

    def viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the units, one after the other, and where each unit's
        end; -1 - c for a character c without a piece."""
        m = self.model
        chars = _points(units)
        n, length = chars.shape
        single = np.isin(chars, self.tables[1][0]) if 1 in self.tables else np.zeros(chars.shape, bool)
        prefix = np.zeros((length + 1, n), np.uint64)
        for e in range(length):
            prefix[e + 1] = prefix[e] * _BASE + chars[:, e]
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        last = np.zeros((length + 1, n), np.int32)  # piece that ends here
        size = np.zeros((length + 1, n), np.int16)  # its length
        for e in range(1, length + 1):
            for k, (keys, ids, maybe) in self.tables.items():
                if k > e:
                    continue
                key = prefix[e] - prefix[e - k] * self.powers[k]
                row = np.flatnonzero(maybe[self._slot(key)] & (best[e - k] > -np.inf))
                key = key[row]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                row, piece = row[hit], ids[at[hit]]
                if m.kind == "bpe" and e > k and len(row):
                    known = last[e - k][row] >= 0  # what stands before is a piece
                    known[known] = ~self._open(last[e - k][row[known]], piece[known])
                    row, piece = row[~known], piece[~known]
                way = best[e - k][row] + m.score[piece]
                better = way > best[e][row]
                row = row[better]
                best[e][row], last[e][row], size[e][row] = way[better], piece[better], k
            bare = ~single[:, e - 1]  # a character without a piece still has a way
            row = np.flatnonzero(bare & (best[e - 1] + m.lowest > best[e]))
            best[e][row], last[e][row], size[e][row] = best[e - 1][row] + m.lowest, -1 - chars[row, e - 1].astype(np.int32), 1
        at = np.array(list(map(len, units)))
        rows, used, trail = np.arange(n), np.zeros(n, np.int64), []
        while len(rows):
            place = at[rows]
            trail.append((rows, last[place, rows]))
            used[rows] += 1
            at[rows] = place = place - size[place, rows]
            rows = rows[place > 0]
        ends = np.cumsum(used)
        ids = np.empty(ends[-1], "<i4")
        for back, (rows, piece) in enumerate(trail, 1):
            ids[ends[rows] - back] = piece
        return ids, ends

    def _written(self, ids: list[int]) -> bytes:
        m, out = self.model, []
        for i in ids:
            if i >= 0:
                out.append(i)
            elif m.bytes:
                out += [m.bytes[b] for b in chr(-1 - i).encode()]
            else:
                out.append(m.unknown)
        return np.array(out, "<i4").tobytes()

    def _learn(self, units: list[str]) -> list[bytes]:
        """Ids of the units as bytes."""
        ids, ends = self.viterbi(units)
        raw, bounds = ids.tobytes(), [0, *ends.tolist()]
        out = [raw[4 * a:4 * b] for a, b in pairwise(bounds)]
        for r in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")).tolist():
            out[r] = self._written(ids[bounds[r]:bounds[r + 1]].tolist())
        return out

    def _split(self, text: str) -> list[str]:
        if self.model.trim:
            text = " ".join(x for x in text.split(" ") if x)
        if text and self.model.prefix:
            text = " " + text
        return _UNIT.findall(text.replace(" ", SPACE))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian signed 32-bit numbers."""
        number: defaultdict[str, int] = defaultdict(count().__next__)
        split = [array("i", map(number.__getitem__, self._split(t))) for t in texts]
        units = list(number)
        uses = np.bincount(np.frombuffer(b"".join(split), np.intc), minlength=len(units))
        written = self._encoded(units, (uses > 1).tolist())
        return [b"".join(map(written.__getitem__, s)) for s in split]

    def _encoded(self, units: list[str], often: list[bool]) -> list[bytes]:
        """Ids of distinct units, learnt or from the cache; kept are those
        used often and those that were kept and are used again."""
        new, old = self.units, self.older
        written = [new.get(u) or old.get(u) for u in units]
        kept = [i for i, (raw, o) in enumerate(zip(written, often)) if raw or o and len(units[i]) <= _LONG]
        need = [i for i, raw in enumerate(written) if raw is None]
        for rows in _batches(list(map(len, units)), need):
            for i, raw in zip(rows, self._learn([units[i] for i in rows])):
                written[i] = raw
        new.update((units[i], written[i]) for i in kept)
        if len(new) > _UNITS:
            self.older, self.units = dict(islice(new.items(), _UNITS)), {}
        return written


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder, with its caches, for all tasks of a Python worker."""
    return Encoder(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row; ``ids`` is an array of piece ids."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for part in slices(batches, "text"):
            raw = encoder.encode(part.column("text").to_pylist())
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])

    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give an empty text.  The
    bytes of the pieces are joined as hex digits, since a character may be
    spread over byte pieces."""
    m = Pieces(model)
    spelt = [b""] * len(m.score)
    for i, piece in m.text.items():
        spelt[i] = piece.encode()
    for i, b in m.byte_of.items():
        spelt[i] = bytes([b])
    spelt[m.unknown] = " ⁇ ".encode()
    digits = F.split(F.lit(",".join([x.hex() for x in spelt])), ",")
    raw = F.unhex(F.array_join(F.transform(ids_col, lambda i: F.get(digits, i)), ""))  # numbers that are no id give null
    text = F.replace(F.make_valid_utf8(raw.cast("string")), F.lit(SPACE), F.lit(" "))
    if m.prefix:
        text = F.regexp_replace(text, r"\A ", "")
    return encoded.withColumn(text_col, F.coalesce(text, F.lit("")))
