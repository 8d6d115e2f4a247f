"""Parquet table access by name below one data folder."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fetch(df: DataFrame, size: int = 1000) -> Iterator[list[Row]]:
    """Rows in lists of ``size``, a partition at a time, so the driver never holds the whole result."""
    rows = df.toLocalIterator(prefetchPartitions=True)
    while block := list(islice(rows, size)):
        yield block


def missing_columns(spark: SparkSession, table: str, *columns: str) -> list[str]:
    """Which of the columns the catalog's table doesn't have, in any case; all of them where there is no such table."""
    if not spark.catalog.tableExists(table):
        return list(columns)
    have = {c.name.lower() for c in spark.catalog.listColumns(table)}
    return [c for c in columns if c.lower() not in have]
