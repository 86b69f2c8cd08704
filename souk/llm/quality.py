"""Quality rules: a log-likelihood ratio of hashed n-grams between a trusted
target and the raw corpus, behind a few plain base rules.

Tokens, in lower case, are runs of letters, digits and underscores, or runs of
other signs.  Every token and pair of neighbours is hashed into ``buckets``.
The raw multinomial counts all documents; the target multinomial counts
documents labelled good, at most ``max_trusted`` of them (smallest id hashes
first).  A document's score is the mean of log(target / raw) over its n-grams.
It is kept if the base rules pass and the score reaches the threshold; no
random draw is involved.

The threshold is derived from labelled rows: one good document in ``HELD`` is
left out of a second target, whose weights score these documents and documents
labelled bad.  The cut between both, among those that pass the base rules, has
the least sum of the share of good ones below and bad ones above; ``THRESHOLD``
serves where either kind has no row.

``measure`` reads each text once: the base counts and the bucket numbers of its
n-grams.  Written to the shared folder, that table serves the counts
(``fit_measured``) and the scores (``verdict``); ``fit`` and ``annotate`` do
the same from texts.

Null and empty texts have no words and fail the base rules; texts are read
whole, of any length.  Rows with a null id are scored but never trusted.
Repeated rows count as often as they occur, and ties of a score at the
threshold are kept.  An empty table gives no rows.  With no trusted document
every weight is zero, so only the base rules decide.  All columns of the input
are passed through untouched, whatever their names, unless they carry one of
``COLUMNS``, in which case that column replaces them.

All of it is DataFrame functions.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.shared import stage

#: A power of two.
BUCKETS = 1 << 14
MAX_TRUSTED = 20_000
SMOOTHING = 1.0
THRESHOLD = -0.15
HELD = 5
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 20, 30, 8  # WINDOW is doubled from pairs
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOL = r"[^#*$%&|<>]+"
_SIGNS = r"[^a-z0-9_\x20\x09-\x0D\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE, -1), lambda w: w != "")


def _tokens(text: Column) -> Column:
    """Words of the text in lower case, with spaces round runs of signs."""
    return _words(F.regexp_replace(F.lower(text), _SIGNS, " $0 "))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _joined(runs: str, by: int) -> Column:
    """Hashes of runs twice as long: each run with the one ``by`` places on."""
    more = F.zip_with(runs, F.slice(runs, F.lit(by + 1), F.size(runs)), lambda a, b: F.xxhash64(a, b))
    return F.slice(more, F.lit(1), F.greatest(F.size(runs) - by, F.lit(0)))


def _bucket(h: Column, buckets: int) -> Column:
    """The leading bits of a hash."""
    return F.shiftrightunsigned(h, 64 - (buckets.bit_length() - 1)).cast("int")


class Weights(list):
    """log(target / raw) of each bucket, and the threshold that goes with it."""

    threshold: float = THRESHOLD


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality",
                max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """At most ``max_trusted`` distinct ids of documents labelled good, and
    ``max_trusted`` / ``HELD`` of documents labelled bad only, with ``good``
    and ``held``: those that the threshold is derived from."""
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
           .groupBy(F.col(id_col).alias("trusted_id")).agg(F.max((F.col(quality_col) == 1).cast("int")).alias("good")))
    first = lambda good, n: ids.where(F.col("good") == good).orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(n)
    return first(1, max_trusted).unionByName(first(0, max_trusted // HELD)).select(
        "trusted_id", "good", ((F.col("good") == 0) | (F.pmod(F.xxhash64("trusted_id"), F.lit(HELD)) == 0)).alias("held"))


def _ratios(raw: dict[int, int], good: dict[int, int], buckets: int, smoothing: float) -> Weights:
    n_raw, n_good = sum(raw.values()), sum(good.values())
    if not n_good:
        return Weights([0.0] * buckets)
    return Weights(math.log((good.get(b, 0) + smoothing) / (n_good + smoothing * buckets))
                   - math.log((raw.get(b, 0) + smoothing) / (n_raw + smoothing * buckets)) for b in range(buckets))


def cut(good: list[float], bad: list[float]) -> float:
    """The score with the least sum of the share of ``good`` below and of
    ``bad`` at or above it: the middle of the widest such gap."""
    if not good or not bad:
        return THRESHOLD
    at = sorted({*good, *bad})
    lost, stay = 0, len(bad)
    n_good, n_bad = Counter(good), Counter(bad)
    best = (stay * len(good), 0.0, at[0])
    for x, y in zip(at, [*at[1:], at[-1]]):
        lost, stay = lost + n_good[x], stay - n_bad[x]
        best = min(best, (lost * len(bad) + stay * len(good), x - y, (x + y) / 2 if x < y else math.nextafter(x, math.inf)))
    return best[2]


def fit_measured(rows: DataFrame, trusted: DataFrame, id_col: str = "doc_id", buckets: int = BUCKETS,
                 smoothing: float = SMOOTHING) -> Weights:
    """log(target / raw) of each bucket, from all rows of ``measure``, and the
    threshold.  ``trusted``: a bounded table of ids (``trusted_ids``)."""
    rows = rows.withColumn("id", F.col("row")[id_col])
    known = rows.join(F.broadcast(trusted), F.col("id") == F.col("trusted_id"), "left")  # max_trusted rows at most, and a part of it
    # 0: not trusted, 1: trusted, 2: trusted and held.  One key and one count serve the three sums.
    kind = F.when(F.col("good") == 1, F.when(F.col("held"), 2).otherwise(1)).otherwise(0)
    # explode_outer: Spark adds a filter on the array's size below explode, and that would build every array again
    counts = (known.select(F.explode_outer("ngrams").alias("b"), kind.alias("kind"))
              .groupBy((F.col("b") * 3 + F.col("kind")).alias("key"))
              .count().where(F.col("key").isNotNull()).collect())  # three times buckets rows
    of = [Counter({r["key"] // 3: r["count"] for r in counts if r["key"] % 3 == k}) for k in range(3)]
    raw = of[0] + of[1] + of[2]
    weights = _ratios(raw, of[1] + of[2], buckets, smoothing)
    without = _ratios(raw, of[1], buckets, smoothing)
    held = rows.join(F.broadcast(trusted.where("held").select("trusted_id", "good")), F.col("id") == F.col("trusted_id"))
    scored = held.select("good", "base_failed", _score(without).alias("score")).collect()
    weights.threshold = cut(*[[r["score"] for r in scored if r["good"] == g and not r["base_failed"]] for g in (1, 0)])
    return weights


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> Weights:
    """:func:`fit_measured` of ``docs``."""
    return fit_measured(measure(docs.select(id_col, text_col), text_col, buckets), trusted, id_col, buckets, smoothing)


def _lines(text: str) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _sorted_windows(words: str, windows: str) -> Column:
    """The windows themselves with their places, sorted.  Null where all
    hashes differ, as in most texts: then no two windows are equal."""
    full = F.transform(F.sequence(F.lit(0), F.size(windows) - 1), lambda i: F.struct(
        F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(full))


def _covered(sorted_windows: str) -> Column:
    """Words in windows that occur twice or more: the union of their spans."""
    s = F.col(sorted_windows)
    again = F.filter(F.transform(s, lambda x, k: F.when(
        (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]), x["i"])), lambda x: x.isNotNull())
    walk = F.aggregate(
        F.array_sort(again), F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + i + F.lit(WINDOW) - F.greatest(a["end"], i)).alias("n"), (i + F.lit(WINDOW)).alias("end")),
        lambda a: a["n"])
    return F.coalesce(walk, F.lit(0)).cast("long")


#: Names that ``annotate`` adds.
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_score", "kept")


def measure(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``row`` (all columns of ``docs``), the base counts and verdict, and
    ``ngrams``: the buckets of the text's tokens and pairs."""
    if buckets < 2 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    # Every array is a column of its own before a lambda reads it: inside the
    # lambda it would be built again for each element.
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("t"), _words(text).alias("w"))
    rows = rows.select("*", _hashes(F.col("w")).alias("r1"), _lines("t").alias("l"))
    for size in (1, 2, 4):  # up to WINDOW
        rows = rows.select("*", _joined(f"r{size}", size).alias(f"r{2 * size}"))
    rows = rows.select("*", _sorted_windows("w", f"r{WINDOW}").alias("s"), _hashes(_tokens(F.col("t"))).alias("k"))
    rows = rows.select("*", F.concat("k", _joined("k", 1)).alias("n"))
    rows = rows.select(
        "row", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("t", _SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _covered("s").alias("n_repeat_words"),
        F.transform("n", lambda h: _bucket(h, buckets)).alias("ngrams"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PCT) * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _score(weights: list[float]) -> Column:
    """Mean weight of the n-grams."""
    # One literal array of fixed length, looked up by bucket.
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate("ngrams", F.lit(0.0), lambda a, b: a + F.get(table, b))
    return F.when(F.size("ngrams") > 0, total / F.size("ngrams")).otherwise(0.0)


def verdict(rows: DataFrame, weights: list[float], threshold: float | None = None) -> DataFrame:
    """Rows of ``measure`` with ``quality_score`` and ``kept``, by default at
    the threshold of the weights."""
    threshold = getattr(weights, "threshold", THRESHOLD) if threshold is None else threshold
    rows = rows.withColumn("quality_score", _score(weights))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold)).drop("ngrams")


def annotate(docs: DataFrame, weights: list[float], text_col: str = "text",
             threshold: float | None = None) -> DataFrame:
    """``docs`` with the base counts, the score and the verdict."""
    rows = verdict(measure(docs, text_col, len(weights)), weights, threshold)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in COLUMNS], *COLUMNS)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float | None = None) -> DataFrame:
    """Rows of :func:`verdict`, fitted on ``docs`` themselves; the texts are
    read once."""
    rows = stage(measure(docs, text_col), "quality")
    return verdict(rows, fit_measured(rows, trusted_ids(labels, id_col), id_col), threshold)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    found = judged(docs, labels, id_col, text_col, threshold).where("kept")
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])
