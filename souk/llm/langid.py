"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier is
trained on hashed byte n-grams (1 to 3 bytes, whole texts): it compares the
n-gram distribution of the languages whose bit is 1 with that of the others,
each language counting the same.  A text's margins on all bits are decoded to
the codeword of least loss, where each bit's loss is weighted by how often
that bit is right on the language's own training texts.  A text whose best two
codewords lie close together is flagged ambiguous.

Only the n-gram table (languages x buckets) and the weights (languages x bits)
reach the driver.

Null texts and texts without a letter get ``und`` with score 0.  Rows with a
null language are not learnt from.  With one language every text with a letter
gets it; with none every text is ``und``.  Repeated rows count as often as
they occur.  Columns other than those named are not read, and ``filter_rows``
passes all columns through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.shared import slices

BUCKETS = 1 << 13
UNKNOWN = "und"
AMBIGUOUS_BELOW = 0.02
_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint32(2654435761)
_BLOCK = 1 << 20  # bytes of a text counted at once


def counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed 1- to 3-gram counts of the text's UTF-8 bytes, A-Z as a-z."""
    data = text.encode("utf-8", "replace").lower()
    total = np.zeros(buckets, np.int64)
    for at in range(0, len(data), _BLOCK):
        a = np.frombuffer(data, np.uint8, min(_BLOCK + 2, len(data) - at), at).astype(np.uint32)
        shift = np.uint32(32 - int(buckets).bit_length() + 1)
        for n in (1, 2, 3):
            m = min(len(a) - n + 1, _BLOCK)
            if m <= 0:
                continue
            code = a[:m] + np.uint32(n << 24)
            for k in range(1, n):
                code = code + (a[k:k + m] << np.uint32(8 * k))
            total += np.bincount((code * _MIX) >> shift, minlength=buckets)
    return total


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1, one row each.  Up to 7 languages: every way
    to split them in two (2**(k-1) - 1 bits).  More: seeded random columns,
    10 log2 k of them, that split the languages."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= 7:
        cols = np.arange(1, 1 << (k - 1))
        return np.where((cols[None, :] >> np.arange(k)[:, None]) & 1, 1.0, -1.0)
    rng = np.random.default_rng(k)
    bits = rng.choice([-1.0, 1.0], size=(k, int(np.ceil(10 * np.log2(k)))))
    bits[0, np.abs(bits.sum(0)) == k] *= -1
    return bits


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds of an n-gram
    trust: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, text: str) -> np.ndarray:
        c = counts(text, self.weights.shape[0])
        return c @ self.weights / max(c.sum(), 1)

    def decode(self, margin: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether the answer is ambiguous."""
        if not self.languages:
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.logaddexp(0, -self.codes * (margin * _SHARP))).sum(1)
        order = np.argsort(loss, kind="stable")
        p = np.exp(-(loss - loss[order[0]]))
        gap = (loss[order[1]] - loss[order[0]]) / (loss[order[1]] + loss[order[0]])
        return self.languages[order[0]], float(1 / p.sum()), bool(gap < AMBIGUOUS_BELOW)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        return self.decode(self.margins(text))


#: Margins are means over n-grams; this brings them to the loss's scale.
_SHARP = 20.0


def _bits(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """buckets x bits: log odds between the two sides of every bit."""
    share = (table + 0.5) / (table + 0.5).sum(1, keepdims=True)
    sides = [np.log(np.maximum(codes * s, 0).T @ share / np.maximum(codes * s, 0).sum(0)[:, None]) for s in (1, -1)]
    return (sides[0] - sides[1]).T


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """Learn from all rows with a text and a language."""
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                if _LETTER.search(text):
                    sums[lang] = sums.get(lang, 0) + counts(text, buckets)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    table = (rows.mapInArrow(count, "lang string, bucket int, n bigint")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())  # languages x buckets at most
    languages = sorted({r["lang"] for r in table})
    codes = codewords(len(languages))
    sums = np.zeros((len(languages), buckets))
    at = {lang: i for i, lang in enumerate(languages)}
    for r in table:
        sums[at[r["lang"]], r["bucket"]] = r["n"]
    model = Model(languages, codes, np.zeros((buckets, codes.shape[1])), np.ones(codes.shape))
    if len(languages) < 2:
        return model
    model.weights = _bits(sums, codes)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((len(languages), codes.shape[1] + 1), np.int64)
        for part in slices(batches, "text"):
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                if _LETTER.search(text):
                    k = at[lang]
                    hits[k, 1:] += model.margins(text) * codes[k] > 0
                    hits[k, 0] += 1
        k, bit = np.nonzero(hits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(bit.astype(np.int32)), pa.array(hits[k, bit])], ["k", "bit", "n"])

    hits = np.zeros((len(languages), codes.shape[1] + 1))
    for r in (rows.mapInArrow(right, "k int, bit int, n bigint").groupBy("k", "bit")
              .agg(F.sum("n").alias("n")).collect()):  # languages x bits at most
        hits[r["k"], r["bit"]] = r["n"]
    share = (hits[:, 1:] + 1) / (hits[:, :1] + 2)
    model.trust = share / share.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) for every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lang, score, unsure = zip(*map(model.predict, part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lang), pa.array(score), pa.array(unsure)],
                ["id", "lang_pred", "score", "ambiguous"])

    return (source.mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean")
            .withColumnRenamed("id", id_col))


def filter_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is known and not ambiguous, all columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            keep = [lang != UNKNOWN and not unsure for lang, _, unsure in map(model.predict, part.column(text_col).to_pylist())]
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
