"""Best representative of each group of duplicates.

One aggregation per group takes, for every attribute, the maximum of a composite
struct. Two results come out of the same pass: the member that ranks first as a
whole, and a record built field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope.functions.identifiers import digest_key


def plausible_size(size: Column) -> Column:
    """``size`` where a file can have it, else null."""
    return F.when(size >= 0, size)


def plausible_year(year: Column, seen: Column) -> Column:
    """``year`` where a file seen at ``seen`` can bear it, else null (unknown ``seen``: any year after 0)."""
    return F.when((year > 0) & (F.coalesce(year <= F.year(seen), F.lit(True))), year)


def rank_struct() -> Column:
    """Composite whose maximum is the preferred file.

    Text-bearing PDFs first, then larger, later, shallower, smaller id; a missing
    flag counts as false, a missing or impossible number as 0.
    """
    zero = F.lit(0)
    return F.struct(
        (F.coalesce(F.col("is_pdf"), F.lit(False)) & ~F.coalesce(F.col("ocr_needed"), F.lit(False))).alias("text_pdf"),
        F.coalesce(plausible_size(F.col("size_bytes")), zero).alias("size"),
        F.coalesce(plausible_year(F.col("modification_year"), F.col("last_seen")), zero).alias("year"),
        (-F.coalesce(F.col("depth"), zero)).alias("shallow"),
        (-F.col("id")).alias("low_id"),
    )


def _field(value: Column, trust: Column, name: str) -> Column:
    """Best value of one field: present before absent, then trust, recency and the value itself."""
    return F.max(
        F.struct(
            value.isNotNull().alias("present"),
            trust.alias("trust"),
            F.col("last_seen").alias("seen"),
            value.alias("value"),
        )
    ).alias(name)


def golden_records(files: DataFrame, trust: Column | None = None) -> DataFrame:
    """One built record per group of two or more ids with one sha256.

    Each of is_pdf, ocr_needed, size_bytes, modification_year and depth is the
    maximum of (present, trust, last_seen, value) over the group, independent of
    the other fields; impossible sizes and years count as absent. ``trust``
    defaults to whether the row's flags agree with its file type. A field absent
    from every member stays null.
    """
    agrees = F.coalesce(F.col("is_pdf") == (F.col("file_type") == ".pdf"), F.lit(False))
    trust = (agrees if trust is None else trust).cast("int")
    size = plausible_size(F.col("size_bytes"))
    year = plausible_year(F.col("modification_year"), F.col("last_seen"))
    rows = files.withColumn("__digest", F.unhex(digest_key(F.col("sha256")))).where("__digest is not null and id is not null")
    groups = rows.groupBy("__digest").agg(
        F.min("id").alias("group_id"),
        F.max("id").alias("high"),
        F.max(rank_struct()).alias("best"),
        _field(F.col("is_pdf"), trust, "f_pdf"),
        _field(F.col("ocr_needed"), trust, "f_ocr"),
        _field(size, trust, "f_size"),
        _field(year, trust, "f_year"),
        _field(F.col("depth"), trust, "f_depth"),
    )
    return groups.where("group_id < high").select(
        "group_id",
        (-F.col("best.low_id")).alias("survivor_id"),
        F.col("f_pdf.value").alias("is_pdf"),
        F.col("f_ocr.value").alias("ocr_needed"),
        F.col("f_size.value").alias("size_bytes"),
        F.col("f_year.value").alias("modification_year"),
        F.col("f_depth.value").alias("depth"),
    )


def representatives(files: DataFrame) -> DataFrame:
    """(group_id, survivor_id) of every group of two or more ids with one sha256: the whole members that rank first
    in the aggregation of :func:`golden_records`.

    The digest is compared however written; null or malformed digests and null ids belong to no group, and a row
    given twice is no group.
    """
    return golden_records(files).select("group_id", "survivor_id")
