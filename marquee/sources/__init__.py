"""Readers: driver tables, the derived raw catalogue, raw CSV, JDBC."""

from marquee.sources.tables import read_table, read_jdbc
from marquee.sources.catalog import raw_catalog, RAW_COLUMNS
from marquee.sources.csv import extract_csv, read_raw_csv

__all__ = ["read_table", "read_jdbc", "raw_catalog", "RAW_COLUMNS", "read_raw_csv", "extract_csv"]
