"""Property test: for random data (ties, NULL keys, one hot group) and any
segment size, the segmented operators equal Spark's plain window functions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from souk.operators.ordered import asc, desc, lag_lead, rank_by_key, rank_within, running_sum

ROW = st.tuples(
    st.sampled_from([0, 0, 0, 1, 2]),                     # group 0 is hot
    st.one_of(st.none(), st.integers(-3, 12).map(float)),  # few distinct keys: ties
    st.one_of(st.none(), st.integers(1, 9)),
)


def _frame(spark, rows):
    data = [(i, g, k, v) for i, (g, k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, g int, k double, v long")


def _same(a, b, cols):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, a.select(*cols).collect()), key=key) == \
        sorted(map(tuple, b.select(*cols).collect()), key=key)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=60), max_rows=st.integers(1, 25),
       descending=st.booleans(), grouped=st.booleans())
def test_segmented_equals_plain(spark, rows, max_rows, descending, grouped):
    df = _frame(spark, rows)
    part = ["g"] if grouped else []
    first = desc("k") if descending else asc("k")
    w = Window.partitionBy(*part).orderBy(first.column())
    expect = df.withColumn("r", F.rank().over(w).cast("long"))
    _same(rank_within(df, part, [first], "r", max_rows=max_rows), expect, ["id", "r"])
    _same(rank_by_key(df, part, [first], "r", max_rows=max_rows), expect, ["id", "r"])

    wt = Window.partitionBy(*part).orderBy(first.column(), F.col("id").asc())
    total = df.withColumn("s", F.sum("v").over(wt.rowsBetween(Window.unboundedPreceding, 0)))
    _same(running_sum(df, "v", part, [first, asc("id")], "s", max_rows=max_rows), total, ["id", "s"])

    if not descending:
        nn = df.where(F.col("k").isNotNull())
        wl = Window.partitionBy(*part).orderBy("k", "id")
        lagged = nn.withColumn("p", F.lag("v").over(wl)).withColumn("n", F.lead("v").over(wl))
        _same(lag_lead(nn, "v", part, [asc("k"), asc("id")], lag="p", lead="n", max_rows=max_rows),
              lagged, ["id", "p", "n"])


DATE_ROW = st.tuples(
    st.sampled_from([0, 0, 0, 1, 2]),
    st.one_of(st.none(), st.integers(0, 6)),   # day offsets: many equal dates
    st.one_of(st.none(), st.integers(1, 9)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(DATE_ROW, min_size=1, max_size=60), max_rows=st.integers(1, 25),
       descending=st.booleans())
def test_composite_date_id_split_equals_plain(spark, rows, max_rows, descending):
    import datetime as dt
    base = dt.date(2018, 3, 1)
    data = [(i, g, None if d is None else base + dt.timedelta(days=d), v)
            for i, (g, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g int, d date, v long")
    order = [desc("d"), desc("id")] if descending else [asc("d"), asc("id")]
    w = Window.partitionBy("g").orderBy(*[o.column() for o in order])
    expect = (df.withColumn("rn", F.row_number().over(w).cast("long"))
              .withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    _same(rank_within(df, ["g"], order, "rn", method="row_number", max_rows=max_rows),
          expect, ["id", "rn"])
    _same(running_sum(df, "v", ["g"], order, "s", max_rows=max_rows), expect, ["id", "s"])
    if not descending:
        nn = df.where(F.col("d").isNotNull())
        wl = Window.partitionBy("g").orderBy("d", "id")
        lagged = nn.withColumn("p", F.lag("v").over(wl)).withColumn("n", F.lead("v").over(wl))
        _same(lag_lead(nn, "v", ["g"], order, lag="p", lead="n", max_rows=max_rows),
              lagged, ["id", "p", "n"])
