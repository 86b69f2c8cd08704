"""The seven commerce tables and their declared schemas.

Every report takes a :class:`Tables` bundle.  A bundle is built either from
parquet folders that already hold the commerce schema (:func:`read_tables`),
from the supplied TPC-H-like test tables through the stand-in mapping
(:mod:`souk.sources.standin`), or from hand-made frames in tests
(:func:`Tables.of`).  All three cast to the same declared types, so report
code sees one schema regardless of origin.  Ids are the exception: a source
with string ids keeps them as strings, all other id types become BIGINT; the
reports only compare, group and order ids, so both kinds work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
ID = T.LongType()
TS = T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "orders": T.StructType([
        T.StructField("order_id", ID, False),
        T.StructField("customer_id", ID, False),
        T.StructField("order_purchase_timestamp", TS, False),
        T.StructField("order_delivered_customer_date", TS, True),
        T.StructField("order_estimated_delivery_date", TS, True),
    ]),
    "order_items": T.StructType([
        T.StructField("order_id", ID, False),
        T.StructField("product_id", ID, False),
        T.StructField("seller_id", ID, False),
        T.StructField("price", MONEY, False),
        T.StructField("freight_value", MONEY, False),
    ]),
    "customers": T.StructType([
        T.StructField("customer_id", ID, False),
        T.StructField("customer_city", T.StringType(), False),
        T.StructField("customer_state", T.StringType(), False),
    ]),
    "products": T.StructType([
        T.StructField("product_id", ID, False),
        T.StructField("product_category_name", T.StringType(), True),
    ]),
    "sellers": T.StructType([
        T.StructField("seller_id", ID, False),
        T.StructField("seller_city", T.StringType(), False),
    ]),
    "order_payments": T.StructType([
        T.StructField("order_id", ID, False),
        T.StructField("payment_value", MONEY, False),
    ]),
    "order_reviews": T.StructType([
        T.StructField("review_id", ID, False),
        T.StructField("order_id", ID, False),
        T.StructField("review_score", T.IntegerType(), False),
        T.StructField("review_creation_date", TS, False),
    ]),
}


ID_COLUMNS = frozenset(f.name for s in SCHEMAS.values() for f in s.fields if f.name.endswith("_id"))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared columns of table ``name`` and cast them
    (string ids stay strings).  Extra columns are dropped here, so the scan
    only reads what is declared."""
    given = df.schema

    def kind(f: T.StructField) -> T.DataType:
        text = f.name in ID_COLUMNS and f.name in given.names and isinstance(given[f.name].dataType, T.StringType)
        return T.StringType() if text else f.dataType
    return df.select([F.col(f.name).cast(kind(f)).alias(f.name) for f in SCHEMAS[name].fields])


class Tables:
    """The seven commerce tables, each conformed to its declared schema.

    Tables are built lazily: a source given as a zero-argument callable is
    only called (files listed, schema analysed) when a report first touches
    that table, and the result is kept.  DataFrames are plans, so keeping
    them holds no data."""

    NAMES = tuple(SCHEMAS)

    def __init__(self, **sources):
        unknown = set(sources) - set(SCHEMAS)
        if unknown:
            raise TypeError(f"unknown tables: {sorted(unknown)}")
        self._sources = sources
        self._built: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}

    def rows(self, name: str) -> int:
        """Number of rows of a table, counted once (Parquet keeps it in the
        file footers).  Reports pass it as a bound to the split windows."""
        if name not in self._rows:
            self._rows[name] = getattr(self, name).count()
        return self._rows[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._built:
            src = self._sources.get(name)
            if src is None:
                raise AttributeError(f"table {name!r} was not given")
            df = src() if callable(src) else src
            self._built[name] = conform(df, name)
        return self._built[name]

    @classmethod
    def of(cls, **frames) -> "Tables":
        """Bundle from DataFrames (or callables returning them)."""
        return cls(**frames)

    @classmethod
    def from_rows(cls, spark: SparkSession, **rows: list) -> "Tables":
        """Bundle from Python rows (tests).  Tables not given are empty."""
        return cls(**{name: spark.createDataFrame(rows.get(name, []), SCHEMAS[name])
                      for name in SCHEMAS})


def read_tables(spark: SparkSession, root: str) -> Tables:
    """Read ``root/<table>`` parquet folders that hold the commerce schema."""
    return Tables(**{name: (lambda n=name: spark.read.parquet(f"{root}/{n}")) for name in SCHEMAS})
