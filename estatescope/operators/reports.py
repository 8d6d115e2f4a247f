"""Audit reports over the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope.operators import dedup
from estatescope.operators.pending import LARGE_BYTES


def audit_totals(files: DataFrame) -> DataFrame:
    """One row: files, PDFs, PDFs that need OCR."""
    return files.agg(
        F.count("*").alias("files"), F.count_if("is_pdf").alias("pdfs"), F.count_if(F.col("is_pdf") & F.col("ocr_needed")).alias("pdfs_to_ocr")
    )


def type_distribution(files: DataFrame) -> DataFrame:
    """Files per type, most first."""
    return files.groupBy("file_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("file_type"))


def depth_distribution(files: DataFrame) -> DataFrame:
    """Files per depth."""
    return files.groupBy("depth").agg(F.count("*").alias("n")).orderBy(F.asc_nulls_last("depth"))


def large_file_listing(files: DataFrame, least: int = LARGE_BYTES) -> DataFrame:
    """Path and size of large files, the largest first."""
    return files.where(F.col("size_bytes") >= least).select("full_path", "size_bytes").orderBy(F.desc_nulls_first("size_bytes"), "full_path")


def stacked_report(files: DataFrame) -> DataFrame:
    """The four audit sections one below the other as (section, item, value)."""
    totals = audit_totals(files).select(F.expr("stack(3, 'files', files, 'pdfs', pdfs, 'pdfs_to_ocr', pdfs_to_ocr) as (item, value)"))
    section = lambda df, name: df.select(F.lit(name).alias("section"), F.col("item").cast("string").alias("item"), F.col("value").cast("long").alias("value"))
    return (
        section(totals, "totals")
        .unionByName(section(type_distribution(files).toDF("item", "value"), "types"))
        .unionByName(section(depth_distribution(files).toDF("item", "value"), "depths"))
        .unionByName(section(large_file_listing(files).toDF("item", "value"), "large_files"))
    )


def write_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header; reports are small."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def executive_summary(files: DataFrame) -> str:
    """Text summary of the duplicates: two single-row aggregates reach the driver."""
    s, t = dedup.duplicate_summary(files).first(), audit_totals(files).first()
    lines = [
        f"Files: {t['files']} (PDF: {t['pdfs']}, to OCR: {t['pdfs_to_ocr']})",
        f"Duplicate groups: {s['groups']}",
        f"Files in duplicate groups: {s['files']}",
        f"Largest group: {s['largest'] or 0} files, {(s['largest_path'] or '-').rsplit('/', 1)[-1]}",
    ]
    return "\n".join(lines) + "\n"
