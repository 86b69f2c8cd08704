"""All reports over string ids: the supplied tables with every id written as a
32-character text that sorts like the number, read back from Parquet.  Split
windows are forced; the answers equal those over numeric ids."""


import pytest
from pyspark.sql import functions as F

from souk.operators.ordered import MAX_ROWS_CONF
from souk.plans import catalog
from souk.sources import read_tables
from souk.sources.tables import ID_COLUMNS, SCHEMAS, Tables
from tests.conftest import SF_SMALL

WINDOWED = ["order_rank_per_customer", "order_rank_joined", "customer_running_sales", "purchase_gaps",
            "order_prev_next", "avg_purchase_gap", "seller_speed_rank", "seller_review_rank", "record_months",
            "moving_avg_category", "customers_above_p90", "sellers_above_median_orders", "category_p90_delivery"]


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("text-ids"))
    base = catalog.tables(spark, SF_SMALL)
    for name in SCHEMAS:
        df = getattr(base, name)
        df.select([F.lpad(F.col(c).cast("string"), 32, "0").alias(c) if c in ID_COLUMNS else F.col(c)
                   for c in df.columns]).write.parquet(f"{root}/{name}")
    return read_tables(spark, root)


def _rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(int(v) if c in ID_COLUMNS and v is not None else v for c, v in zip(df.columns, r)))
    return sorted(out, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_ids_keep_their_type(spark, texts):
    assert dict(texts.orders.dtypes)["order_id"] == "string"
    assert dict(catalog.tables(spark, SF_SMALL).orders.dtypes)["order_id"] == "bigint"
    mixed = Tables.of(sellers=spark.createDataFrame([(7, "X")], "seller_id int, seller_city string"))
    assert dict(mixed.sellers.dtypes)["seller_id"] == "bigint"


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_report_on_text_ids(spark, texts, name):
    report, arguments = catalog.REGISTRY[name]
    assert _rows(report(texts, **arguments)) == _rows(report(catalog.tables(spark, SF_SMALL), **arguments))


@pytest.mark.parametrize("name", WINDOWED)
def test_split_windows_on_text_ids(spark, texts, name):
    report, arguments = catalog.REGISTRY[name]
    want = _rows(report(texts, **arguments))
    spark.conf.set(MAX_ROWS_CONF, "4")
    try:
        assert _rows(report(texts, **arguments)) == want
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
