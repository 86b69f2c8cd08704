"""top_k: exact cut with id tie-break, rank keeps ties, dense rank counts
distinct values; per group and overall."""

from souk.operators import asc, desc, top_k


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_ties_modes(spark):
    df = spark.createDataFrame(
        [(1, "a", 10), (2, "a", 10), (3, "a", 9), (4, "a", 8), (5, "b", 1)], "id int, g string, v int")
    cut = top_k(df, [desc("v"), asc("id")], 2, partition=["g"])
    assert _rows(cut) == [(1, "a", 10), (2, "a", 10), (5, "b", 1)]
    ranked = top_k(df, [desc("v")], 2, partition=["g"], ties="rank", rank_col="r")
    assert _rows(ranked) == [(1, "a", 10, 1), (2, "a", 10, 1), (5, "b", 1, 1)]
    dense = top_k(df, [desc("v")], 2, partition=["g"], ties="dense", rank_col="r")
    assert _rows(dense) == [(1, "a", 10, 1), (2, "a", 10, 1), (3, "a", 9, 2), (5, "b", 1, 1)]
    overall = top_k(df, [desc("v"), asc("id")], 3)
    assert _rows(overall) == [(1, "a", 10), (2, "a", 10), (3, "a", 9)]


def test_large_k_takes_two_cuts(spark):
    df = spark.range(6000).selectExpr("id", "id % 2 AS g", "id DIV 4 AS v")
    assert "_topk_part" in top_k(df, [desc("v")], 1001, ["g"], "rank")._jdf.queryExecution().optimizedPlan().toString()
    for ties, want in (("cut", 2002), ("rank", 2004), ("dense", 4004)):
        rows = _rows(top_k(df, [desc("v")], 1001, ["g"], ties, "r"))
        assert len(rows) == want and min(r[2] for r in rows) == 1500 - -(-want // 4)
