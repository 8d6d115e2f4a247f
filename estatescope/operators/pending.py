"""Which rows a stage still has to work on, and in which order it takes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.functions.paths import extension_of_path

#: File types of pictures, for the document detector and for captions.
DETECTOR_TYPES = ("jpg", "jpeg", "png", "tif", "tiff", "bmp")
CAPTION_TYPES = (".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tiff", ".webp")
LARGE_BYTES = 104857600


def needs_pdf_check() -> Column:
    return F.col("is_pdf") & F.col("ocr_needed").isNull()


def needs_hash() -> Column:
    return F.col("xxhash64").isNull() | F.col("sha256").isNull() | F.col("hash_pending")


def needs_text() -> Column:
    return F.col("text_excerpt").isNull()


def needs_ocr() -> Column:
    empty = F.col("text_excerpt").isNull() | (F.col("text_excerpt") == "")
    return F.col("ocr_needed") & empty & F.col("canonical_id").isNull()


def needs_class() -> Column:
    return F.col("categoria").isNull() & F.col("text_excerpt").isNotNull() & F.col("canonical_id").isNull()


def is_captionable() -> Column:
    return F.lower("file_type").isin(*CAPTION_TYPES)


def is_undecided_picture() -> Column:
    """Hashed pictures marked as not in need of OCR, which a second check may look at."""
    kind = F.lower(F.element_at(F.split("full_path", r"\."), -1))
    return (F.col("ocr_needed") == F.lit(False)) & kind.isin(*DETECTOR_TYPES, "webp") & F.col("xxhash64").isNotNull()


def ready_for_etl() -> Column:
    return F.col("hash_pending") == F.lit(False)


def pending_pdf(files: DataFrame) -> DataFrame:
    return files.where(needs_pdf_check())


def pending_hash(files: DataFrame) -> DataFrame:
    return files.where(needs_hash())


def large_files(files: DataFrame, least: int = LARGE_BYTES) -> DataFrame:
    """Files of at least ``least`` bytes."""
    return files.where(F.col("size_bytes") >= least)


def pending_text(files: DataFrame) -> DataFrame:
    return files.where(needs_text())


def pending_ocr(files: DataFrame, in_flight: DataFrame | None = None) -> DataFrame:
    """Files that wait for OCR; with ``in_flight`` (file_id) those already sent are left out."""
    out = files.where(needs_ocr())
    return out if in_flight is None else out.join(in_flight.select(F.col("file_id").alias("id")), "id", "left_anti")


def pending_classify(files: DataFrame) -> DataFrame:
    return files.where(needs_class())


def pending_images(files: DataFrame, task_map: DataFrame, canonical_only: bool = True) -> DataFrame:
    """Pictures without a task; counting looks at canonical files only, sending at all."""
    out = files.where(is_captionable())
    out = out.where("canonical_id is null") if canonical_only else out
    return out.join(task_map.select(F.col("file_id").alias("id")), "id", "left_anti")


def undecided_pictures(files: DataFrame) -> DataFrame:
    """The first file of every hash among the pictures a second check may look at."""
    return first_per_hash(files.where(is_undecided_picture()))


def first_per_hash(df: DataFrame, key: str = "xxhash64") -> DataFrame:
    """The row of smallest id of every key; all null keys form one group."""
    best = df.groupBy(key).agg(F.min("id").alias("id"))
    return df.join(best.select("id"), "id", "left_semi")


def image_candidates(files: DataFrame, strict: bool = False) -> DataFrame:
    """Representatives of the pictures the document detector looks at.

    As the pipeline has it, a picture's file type qualifies whatever ocr_needed says;
    ``strict`` asks for ocr_needed to be false in either case.
    """
    by_path = F.lower(extension_of_path(F.col("full_path"))).isin(*DETECTOR_TYPES)
    by_type = F.lower("file_type").isin(*[f".{x}" for x in DETECTOR_TYPES])
    flag = F.coalesce(F.col("ocr_needed") == F.lit(False), F.lit(False))
    picked = files.where(flag & (by_path | by_type) if strict else (flag & by_path) | F.coalesce(by_type, F.lit(False)))
    return first_per_hash(picked)


def next_batch(df: DataFrame, size: int = 500) -> DataFrame:
    """The first ``size`` rows by id: one dispatch batch."""
    return df.orderBy("id").limit(size)


def chunk_numbers(df: DataFrame, size: int) -> DataFrame:
    """``df`` with the number of the batch of ``size`` rows it falls into, by id.

    Ranks are counted per range partition and offset by the sizes of the ranges
    before, so no single task orders the table. The ranges are written once, since they may be cut
    differently each time they are made.
    """
    ranged = workspace.materialize(df.repartitionByRange("id").withColumn("__p", F.spark_partition_id()), "ranges")
    local = ranged.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy("id")))
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__n"))  # one row per partition
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = local.join(F.broadcast(before.select("__p", "__before")), "__p")
    return out.withColumn("chunk", F.floor((F.col("__before") + F.col("__r") - 1) / size)).drop("__p", "__r", "__before")


def pending_counts(files: DataFrame, task_map: DataFrame) -> DataFrame:
    """One row with what every stage still has to do."""
    done = task_map.select(F.col("file_id").alias("id"), F.lit(1).alias("__sent")).distinct()
    image = is_captionable() & F.col("canonical_id").isNull() & F.col("__sent").isNull()
    return files.join(done, "id", "left").agg(
        F.count_if(needs_hash()).alias("hash"), F.count_if(needs_pdf_check()).alias("pdf"), F.count_if(needs_text()).alias("text"),
        F.count_if(needs_ocr()).alias("ocr"), F.count_if(needs_class()).alias("classify"), F.count_if(image).alias("image"),
        F.count_if(ready_for_etl()).alias("etl"),
    )
