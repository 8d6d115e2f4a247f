"""Directory walker as a Spark data source.

``spark.read.format("estate").option("path", base).load()`` lists every file below the
base's directories. An input partition is a directory with all below it; directories are opened level by level until
there are enough of them, so one huge top-level folder is shared out too. Empty and hidden
files are listed, symbolic links are not followed, unreadable folders are skipped, and
files directly in the base are listed only with ``includeRootFiles``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from estatescope.functions import paths

SCHEMA = "path string, name string, size long, ctime double, mtime double"


#: Partitions aimed at, and most directories the driver opens for it.
ENOUGH, MOST_OPENED = 64, 4096


class _Root(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


def _rows(folder: str, deep: bool) -> Iterator[tuple]:
    waiting = [folder]
    while waiting:
        try:
            entries = sorted(os.scandir(waiting.pop()), key=lambda e: e.name)
        except OSError:
            continue
        for entry in entries:
            try:
                if entry.is_symlink():
                    continue
                if entry.is_dir(follow_symlinks=False):
                    if deep:
                        waiting.append(entry.path)
                elif entry.is_file(follow_symlinks=False):
                    s = entry.stat(follow_symlinks=False)
                    yield entry.path, entry.name, s.st_size, s.st_ctime, s.st_mtime
            except OSError:
                continue


def _folders(path: str) -> list[str]:
    try:
        return sorted(e.path for e in os.scandir(path) if e.is_dir(follow_symlinks=False) and not e.is_symlink())
    except OSError:
        return []


class _Reader(DataSourceReader):
    def __init__(self, base: str, root_files: bool):
        self.base, self.root_files = base, root_files

    def partitions(self) -> list[_Root]:
        whole, opened = _folders(self.base), [self.base] if self.root_files else []
        count = 1
        while whole and len(whole) + len(opened) < ENOUGH and count < MOST_OPENED:
            # an opened folder leaves its own files to a partition
            opening, kept = whole[: MOST_OPENED - count], whole[MOST_OPENED - count :]
            count += len(opening)
            opened += opening
            whole = [inner for path in opening for inner in _folders(path)] + kept
        return [_Root(p, True) for p in whole] + [_Root(p, False) for p in opened]

    def read(self, partition: _Root) -> Iterator[tuple]:
        return _rows(partition.path, partition.deep)


class EstateSource(DataSource):
    """Data source ``estate``; options: path, includeRootFiles."""

    @classmethod
    def name(cls) -> str:
        return "estate"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("includerootfiles", self.options.get("includeRootFiles", "false")).lower() == "true")


def walk(spark: SparkSession, base: str, include_root_files: bool = False) -> DataFrame:
    """Files below ``base``; the folder must be mounted alike on all executors."""
    spark.dataSource.register(EstateSource)
    return spark.read.format("estate").option("path", base).option("includeRootFiles", str(include_root_files).lower()).load()


def inventory(files: DataFrame, base: str) -> DataFrame:
    """Walked files as inventory columns."""
    ext = paths.extension(F.col("name"))
    year = lambda c: paths.epoch_year(F.floor(c).cast("long"))
    return files.select(
        F.col("path").alias("full_path"), F.col("name").alias("file_name"), ext.alias("file_type"), F.col("size").alias("size_bytes"),
        year(F.col("ctime")).alias("creation_year"), year(F.col("mtime")).alias("modification_year"),
        paths.path_depth(F.col("path"), base.rstrip("/").count("/")).alias("depth"), paths.is_pdf(ext).alias("is_pdf"),
    )


def csv_flags(spark: SparkSession, path: str) -> DataFrame:
    """(full_path, ocr_needed) of a CSV listing with these two columns."""
    from estatescope.functions.cleaning import truthy_flag

    raw: DataFrame = spark.read.option("header", True).csv(path)
    flag: Column = truthy_flag(F.col("ocr_needed"))
    return raw.select("full_path", F.coalesce(flag, F.lit(False)).alias("ocr_needed"))
