"""Compare each row of an aggregate against one statistic of the same
aggregate (mean, max, median, percentile).

The statistic is a global aggregate of the input, i.e. exactly one row: a
scalar subquery (``DataFrame.scalar``, run once) or a one-row side joined with
``broadcast``, safe at any scale; it is never collected to the driver.  The
functions take aggregate expressions, not frames, so a statistic of many rows
cannot be passed.  The statistic also counts every other column, so its branch
reads what the rows' branch reads and Spark reuses the shuffle for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.operators.ordered import asc, running_sum


def _statistics(df: DataFrame, **aggregates: Column) -> DataFrame:
    """One row with the column ``_stat``, a struct of the aggregates."""
    named = [a.alias(n) for n, a in aggregates.items()]
    return df.agg(F.struct(*named, *[F.count(c).alias(f"_n_{i}") for i, c in enumerate(df.columns)]).alias("_stat"))


def above_mean(df: DataFrame, value: str) -> DataFrame:
    """Rows with ``value`` greater than the mean of ``value``.

    Compared as ``value * n > total``: exact for decimals and integers, with
    no rounding of the mean."""
    stat = _statistics(df, total=F.sum(value), n=F.count(value)).scalar()
    return df.where(F.col(value) * stat["n"] > stat["total"])


def equal_to_max(df: DataFrame, value: str) -> DataFrame:
    """Rows whose ``value`` equals the maximum of ``value``."""
    return df.where(F.col(value) == _statistics(df, most=F.max(value)).scalar()["most"])


def percentile_of(value: str, p: float, accuracy: int | None = None) -> Column:
    """Continuous percentile ``p`` as an aggregate expression.

    Exact by default, from a value -> count map per group (small for counts
    and day differences; see :func:`percentile_cont` for any number of
    values).  ``accuracy`` switches to the mergeable ``percentile_approx``
    sketch (relative rank error about 1/accuracy; it returns an input value,
    not an interpolation)."""
    if accuracy:
        return F.percentile_approx(F.col(value), F.lit(p), F.lit(accuracy)).cast("double")
    return F.percentile(F.col(value), F.lit(p))


def percentile_cont(df: DataFrame, value: str, p: float, partition: Sequence[str] = (), weight: str | None = None,
                    max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Continuous percentile ``p`` (linear interpolation, as
    ``PERCENTILE_CONT``) by selection: ``partition`` columns and ``percentile``
    (double), NULL where a group has no value.

    Rows are counted per distinct value (``weight``: rows a row stands for),
    the counts are summed up in value order by the split running sum, and the
    one or two middle ranks are picked from them.  No task holds a group's
    values."""
    if not 0 <= p <= 1:
        raise ValueError("p must be between 0 and 1")
    n = F.sum(weight) if weight else F.count(F.lit(1))
    group = F.struct(*partition) if partition else F.lit(0)
    counts = (df.select(group.alias("_group"), F.col(value).cast("double").alias("_v"), *([weight] if weight else []))
              .groupBy("_group", "_v").agg(n.cast("long").alias("_c")))
    upto = running_sum(counts.where(F.col("_v").isNotNull()), "_c", ["_group"], [asc("_v")], "_upto",
                       max_rows=max_rows, rows=rows)
    totals = counts.groupBy("_group").agg(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))).alias("_n"))
    at = (F.col("_n") - 1) * F.lit(float(p))
    # the value that holds a rank (from 0): the first whose running count passes it
    holds = lambda rank: (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)
    picked = (totals.join(upto, "_group", "left").withColumn("_at", at)
              .where(F.col("_v").isNull() | holds(F.floor("_at")) | holds(F.ceil("_at")))
              .groupBy("_group").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_at").alias("_at")))
    low, high = F.floor("_at"), F.ceil("_at")
    result = (F.when(low == high, F.col("_lo"))
              .otherwise((high - F.col("_at")) * F.col("_lo") + (F.col("_at") - low) * F.col("_hi")))
    return picked.select(*[F.col("_group")[c].alias(c) for c in partition], result.alias("percentile"))


def above_percentile(df: DataFrame, value: str, p: float, accuracy: int | None = None,
                     max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Rows above the continuous percentile ``p`` of ``value``."""
    one = (df.agg(percentile_of(value, p, accuracy).alias("percentile")) if accuracy
           else percentile_cont(df, value, p, max_rows=max_rows, rows=rows).agg(F.max("percentile").alias("percentile")))
    return (df.join(F.broadcast(one.withColumnRenamed("percentile", "_p")), F.col(value) > F.col("_p"))
            .drop("_p"))


def above(df: DataFrame, value: str | Column, threshold: Column) -> DataFrame:
    """Theta join against a global aggregate of ``df``: ``value > threshold``."""
    value = F.col(value) if isinstance(value, str) else value
    one = F.broadcast(_statistics(df, threshold=threshold))
    return df.join(one, value > F.col("_stat.threshold"), "inner").drop("_stat")
