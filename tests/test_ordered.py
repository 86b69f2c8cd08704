"""The segmented window operators equal Spark's plain window functions for
any split (tiny ``max_rows`` forces many segments), with ties and NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from souk.operators.ordered import (asc, desc, lag_lead, moving, rank_by_key, rank_within, running_max,
                                    running_sum)


def _rows(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = 0 if rnd.random() < 0.6 else rnd.randint(1, 6)   # group 0 is hot
        k = None if rnd.random() < 0.05 else float(rnd.randint(0, 30)) + rnd.choice([0.0, 0.5])
        out.append((i, g, k, rnd.randint(1, 9)))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(7), "id long, g int, k double, v long")


def _same(a, b, cols):
    ra = sorted(a.select(*cols).collect())
    rb = sorted(b.select(*cols).collect())
    assert ra == rb


@pytest.mark.parametrize("max_rows", [3, 40, 10_000])
@pytest.mark.parametrize("partition", [[], ["g"]])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_rank_matches_window(frame, max_rows, partition, direction):
    order = [desc("k") if direction == "desc" else asc("k")]
    w = Window.partitionBy(*partition).orderBy(order[0].column())
    expect = frame.withColumn("r", F.rank().over(w).cast("long"))
    got = rank_within(frame, partition, order, "r", max_rows=max_rows)
    _same(got, expect, ["id", "r"])
    got2 = rank_by_key(frame, partition, order, "r", max_rows=max_rows)
    _same(got2, expect, ["id", "r"])


@pytest.mark.parametrize("max_rows", [3, 40])
def test_row_number_and_running_sum(frame, max_rows):
    order = [asc("k"), asc("id")]
    w = Window.partitionBy("g").orderBy(F.col("k").asc(), F.col("id").asc())
    expect = (frame.withColumn("rn", F.row_number().over(w).cast("long"))
              .withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("x", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    got = rank_within(frame, ["g"], order, "rn", method="row_number", max_rows=max_rows)
    _same(got, expect, ["id", "rn"])
    got = running_sum(frame, "v", ["g"], order, "s", max_rows=max_rows)
    _same(got, expect, ["id", "s"])
    got = running_sum(frame, "v", ["g"], order, "x", exclusive=True, max_rows=max_rows)
    _same(got, expect, ["id", "x"])


@pytest.mark.parametrize("max_rows", [3, 40])
def test_lag_lead(frame, max_rows):
    f = frame.where(F.col("k").isNotNull())
    order = [asc("k"), asc("id")]
    w = Window.partitionBy("g").orderBy("k", "id")
    expect = f.withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    got = lag_lead(f, "v", ["g"], order, lag="p", lead="n", max_rows=max_rows)
    _same(got, expect, ["id", "p", "n"])


def test_hot_group_is_split(frame):
    from souk.operators.ordered import segments
    s = segments(frame, ["g"], asc("k"), max_rows=100)
    assert s.where(F.col("g") == 0).select("_seg").distinct().count() > 3
    assert [r[0] for r in s.where(F.col("g") != 0).select("_seg").distinct().collect()] == [0]


def test_hot_group_on_one_date_is_split_by_second_key(spark):
    import datetime as dt
    day = dt.date(2018, 3, 5)
    rows = [(i, 0, day, i % 7) for i in range(200)] + [(1000 + i, 1, day, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, g int, d date, v long")
    order = [asc("d"), asc("id")]
    from souk.operators.ordered import segments
    s = segments(df, ["g"], order, max_rows=20)
    assert s.where(F.col("g") == 0).select("_seg").distinct().count() > 5
    w = Window.partitionBy("g").orderBy("d", "id")
    expect = (df.withColumn("p", F.lag("v").over(w))
              .withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    got = lag_lead(df, "v", ["g"], order, lag="p", max_rows=20)
    _same(got, expect, ["id", "p"])
    got = running_sum(df, "v", ["g"], order, "s", max_rows=20)
    _same(got, expect, ["id", "s"])


def test_timestamp_keys_split_exactly(spark):
    import datetime as dt
    base = dt.datetime(2018, 3, 5, 10, 0, 0)
    rows = [(i, 0, base + dt.timedelta(microseconds=i % 13), i) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, g int, ts timestamp_ntz, v long")
    order = [asc("ts"), asc("id")]
    w = Window.partitionBy("g").orderBy("ts", "id")
    expect = df.withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    got = lag_lead(df, "v", ["g"], order, lag="p", lead="n", max_rows=7)
    _same(got, expect, ["id", "p", "n"])


def test_outliers_do_not_unbalance_ranges(spark):
    # one far value stretches the equal-width range of the hot group: the
    # second level splits the crowded range again
    rows = [(0, 0, 0.0, 1)] + [(i, 0, 1e6 + i, i % 5) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "id long, g int, k double, v long")
    from souk.operators.ordered import segments
    s = segments(df, ["g"], asc("k"), max_rows=40)
    sizes = [r[1] for r in s.groupBy("_seg").count().collect()]
    assert max(sizes) <= 40
    w = Window.partitionBy("g").orderBy("k")
    expect = df.withColumn("r", F.rank().over(w).cast("long")) \
        .withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    _same(rank_within(df, ["g"], [asc("k")], "r", max_rows=40), expect, ["id", "r"])
    _same(running_sum(df, "v", ["g"], [asc("k")], "s", max_rows=40), expect, ["id", "s"])
    d = desc("k")
    wd = Window.partitionBy("g").orderBy(d.column())
    _same(rank_within(df, ["g"], [d], "r", max_rows=40),
          df.withColumn("r", F.rank().over(wd).cast("long")), ["id", "r"])


def test_null_first_keys_split_by_second_key(spark):
    import datetime as dt
    rows = [(i, 0, None if i % 3 else dt.date(2018, 1, 1 + i % 5), i % 7) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, g int, d date, v long")
    from souk.operators.ordered import segments
    s = segments(df, ["g"], [asc("d"), asc("id")], max_rows=20)
    null_segs = s.where(F.col("d").isNull()).select("_seg").distinct().count()
    assert null_segs > 3
    for order in ([asc("d"), asc("id")], [desc("d"), desc("id")]):
        w = Window.partitionBy("g").orderBy(*[o.column() for o in order])
        expect = (df.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("rn", F.row_number().over(w).cast("long")))
        _same(running_sum(df, "v", ["g"], order, "s", max_rows=20), expect, ["id", "s"])
        _same(rank_within(df, ["g"], order, "rn", method="row_number", max_rows=20), expect, ["id", "rn"])
    w = Window.partitionBy("g").orderBy("d", "id")
    expect = df.withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    _same(lag_lead(df, "v", ["g"], [asc("d"), asc("id")], lag="p", lead="n", max_rows=20),
          expect, ["id", "p", "n"])


def test_max_rows_from_session_conf(spark, frame):
    from souk.operators.ordered import MAX_ROWS_CONF, segments
    spark.conf.set(MAX_ROWS_CONF, "20")
    try:
        split = segments(frame, ["g"], asc("k")).where(F.col("g") == 0).select("_seg").distinct().count()
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
    whole = segments(frame, ["g"], asc("k")).where(F.col("g") == 0).select("_seg").distinct().count()
    assert split > 3 and whole == 1


def test_null_second_key_inside_null_band(spark):
    rows = [(i, 0, None if i % 2 else float(i % 4), None if i % 5 == 0 else float(i % 9), i % 7)
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, a double, b double, v long")
    for order in ([asc("a"), asc("b"), asc("id")], [desc("a"), desc("b"), desc("id")]):
        w = Window.partitionBy("g").orderBy(*[o.column() for o in order])
        expect = df.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        _same(running_sum(df, "v", ["g"], order, "s", max_rows=16), expect, ["id", "s"])


def _plain(order, *part):
    return Window.partitionBy(*part).orderBy(*[o.column() for o in order])


def test_tied_keys_spread_over_segments(spark):
    # 5,000 equal keys: no segment above 2 x max_rows, ranks as the plain window
    rows = [(i, 0, 5.0 if i < 5000 else float(i % 40)) for i in range(6000)] + [(9000 + i, 1, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, g int, k double")
    from souk.operators.ordered import segments
    for order in ([asc("k")], [desc("k")]):
        sizes = [r[1] for r in segments(df, ["g"], order, max_rows=100).groupBy("_gk", "_seg").count()
                 .select("_seg", "count").collect()]
        assert max(sizes) <= 200 and len(sizes) > 60
        got = rank_within(df, ["g"], order, "r", max_rows=100)
        _same(got, df.withColumn("r", F.rank().over(_plain(order, "g")).cast("long")), ["id", "r"])


def test_string_keys_and_mixed_directions(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("aäß0z ") for _ in range(rnd.randint(0, 3)))
    rows = [(f"{i * 7919 % 1000:032d}", "hot" if i % 4 else word(), rnd.choice([None, word()]), rnd.randint(1, 9))
            for i in range(900)]
    df = spark.createDataFrame(rows, "id string, g string, k string, v long")
    for order in ([asc("k"), asc("id")], [desc("k"), asc("id")], [asc("k"), desc("v"), asc("id")]):
        w = _plain(order, "g")
        expect = (df.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("n", F.row_number().over(w).cast("long")).withColumn("p", F.lag("id").over(w))
                  .withColumn("q", F.lead("id").over(w)))
        key = lambda r: tuple((x is not None, x) for x in r)
        want = {r["id"]: (r["s"], r["n"], r["p"], r["q"]) for r in expect.collect()}
        got = running_sum(df, "v", ["g"], order, "s", max_rows=30)
        assert {r["id"]: r["s"] for r in got.collect()} == {i: t[0] for i, t in want.items()}
        got = rank_within(df, ["g"], order, "n", "row_number", max_rows=30)
        assert {r["id"]: r["n"] for r in got.collect()} == {i: t[1] for i, t in want.items()}
        got = lag_lead(df, "id", ["g"], order, lag="p", lead="q", max_rows=30)
        assert {r["id"]: (r["p"], r["q"]) for r in got.collect()} == {i: t[2:] for i, t in want.items()}


def test_far_infinite_and_nan_keys_stay_balanced(spark):
    from souk.operators.ordered import segments
    keys = [10.0 ** (i % 300) * (1 + i / 7000) for i in range(3000)] + [float("inf")] * 40 + [float("-inf")] * 40
    rows = [(i, 0, k) for i, k in enumerate(keys + [float("nan")] * 40 + [None] * 40)]
    df = spark.createDataFrame(rows, "id long, g int, k double")
    for order in ([asc("k")], [desc("k")]):
        sizes = [r[1] for r in segments(df, ["g"], order, max_rows=100).groupBy("_seg").count().collect()]
        assert max(sizes) <= 200
        _same(rank_within(df, ["g"], order, "r", max_rows=100),
              df.withColumn("r", F.rank().over(_plain(order, "g")).cast("long")), ["id", "r"])


@pytest.mark.parametrize("max_rows", [2, 30, 10_000])
@pytest.mark.parametrize("width", [1, 3, 8])
def test_moving_frame_crosses_segments(spark, max_rows, width):
    rnd = random.Random(9)
    rows = [(i, 0 if i % 5 else i % 3, rnd.randint(0, 50), None if rnd.random() < 0.3 else rnd.randint(1, 9))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, k long, v long")
    order = [asc("k"), desc("id")]
    w = _plain(order, "g").rowsBetween(-(width - 1), 0)
    expect = df.withColumn("t", F.sum("v").over(w)).withColumn("c", F.count("v").over(w))
    got = {r["id"]: (r["t"], r["c"]) for r in moving(df, "v", ["g"], order, width, "t", "c", max_rows=max_rows).collect()}
    assert got == {r["id"]: (r["t"], r["c"]) for r in expect.collect()}


@pytest.mark.parametrize("exclusive", [False, True])
def test_running_max_with_carry(spark, exclusive):
    rnd = random.Random(4)
    rows = [(i, i % 2 if i % 7 == 0 else 0, None if rnd.random() < 0.2 else rnd.randint(0, 400)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g int, v long")
    w = _plain([asc("id")], "g").rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    got = running_max(df, "v", ["g"], [asc("id")], "m", exclusive=exclusive, max_rows=20)
    assert {r["id"]: r["m"] for r in got.collect()} == \
        {r["id"]: r["m"] for r in df.withColumn("m", F.max("v").over(w)).collect()}


def test_row_bound_decides_the_plan(spark, frame):
    def plan(**kw):
        df = rank_within(frame, ["g"], [asc("k")], "r", max_rows=40, **kw)
        return df, df._jdf.queryExecution().optimizedPlan().toString()
    want, open_plan = plan()
    few, small = plan(rows=40)
    some, hinted = plan(rows=400)
    assert "Join" not in small and "Join" in open_plan
    assert "strategy=broadcast" in hinted and "strategy=broadcast" not in open_plan
    _same(few, want, ["id", "r"])
    _same(some, want, ["id", "r"])


def test_equal_rows_stay_one_sample_entry(spark):
    df = spark.createDataFrame([(0, 1.0)] * 500 + [(0, float(i)) for i in range(2, 60)], "g int, k double")
    got = sorted(map(tuple, rank_within(df, ["g"], [asc("k")], "r", max_rows=20).collect()))
    assert got == [(0, 1.0, 1)] * 500 + [(0, float(i), 499 + i) for i in range(2, 60)]
