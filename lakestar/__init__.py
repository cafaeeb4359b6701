"""Layered star-schema analytics on PySpark: raw extracts -> conformed tables
-> customer/product dimensions and a sales fact, with data-quality reports
and revenue queries, all as built-in DataFrame operations."""

__version__ = "0.1.0"
