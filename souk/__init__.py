"""souk: marketplace analytics (orders, items, customers, products, sellers,
payments, reviews) as Spark DataFrame plans."""

from souk.sources import Tables, read_tables, standin_tables

__all__ = ["Tables", "read_tables", "standin_tables"]
