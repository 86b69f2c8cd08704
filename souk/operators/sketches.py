"""Distinct counts from mergeable sketches, for those who opt in.

An exact distinct count must keep every value until the end and starts again
for each grouping.  A HyperLogLog sketch per fine group is a few kB, is built
in one pass with map-side merging, and merges into any coarser group:
``sketch`` once, ``rolled_up`` for as many groupings as are wanted.

With ``2 ** lg_k`` registers the relative standard error of an estimate is
about ``1.04 / sqrt(2 ** lg_k)`` (``relative_error``; 1.6 % at 12); NULLs are
not counted, as in ``COUNT(DISTINCT)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate, as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)


def sketch(df: DataFrame, by: Sequence[str | Column], value: str, out: str = "sketch", lg_k: int = LG_K,
           **aggregates: Column) -> DataFrame:
    """Per group of ``by``: a sketch of the distinct ``value`` and other aggregates."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(value), lg_k).alias(out),
                               *[a.alias(n) for n, a in aggregates.items()])


def estimate(merged: str = "sketch") -> Column:
    """Aggregate: distinct values of the merged sketches (long)."""
    return F.hll_sketch_estimate(F.hll_union_agg(F.col(merged)))


def rolled_up(sketches: DataFrame, sets: Sequence[Sequence[str]], out: str, merged: str = "sketch",
              **aggregates: Column) -> DataFrame:
    """Estimates for several groupings of ``sketches`` at once: the columns of
    all ``sets`` (NULL where a set lacks one), ``grouping`` (number of the set
    in ``sets``) and the estimate ``out``."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    # bit i of grouping_id is set where column i (from the left) is rolled up
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    which = F.element_at(F.create_map(*[F.lit(x) for i, g in enumerate(ids) for x in (g, i)]),
                         F.grouping_id().cast("int"))
    return (sketches.groupingSets([list(s) for s in sets], *columns)
            .agg(which.alias("grouping"), estimate(merged).alias(out), *[a.alias(n) for n, a in aggregates.items()]))
