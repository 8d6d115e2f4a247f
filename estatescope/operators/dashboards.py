"""Dashboard aggregates: facts of the star schema joined to the dimensions asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatescope.operators.pending import needs_ocr
from estatescope.operators.star import NO_CLASS, Star

_LEVELS = [f"level{k}" for k in range(1, 6)]


def _measures() -> list:
    return [F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes")]


def directories(star: Star) -> DataFrame:
    """Count and size by directory level, with subtotals of every level above (grouping sets)."""
    facts = star.beside("directories", *_LEVELS).select("size_bytes", *_LEVELS)
    return facts.rollup(*_LEVELS).agg(F.grouping_id().cast("int").alias("subtotal"), *_measures())


def file_types(star: Star) -> DataFrame:
    return star.by("file_types").groupBy("filetype_id").agg(*_measures()).join(star.file_types, "filetype_id").select("file_type", "files", "bytes")


def classes(star: Star) -> DataFrame:
    """Count and size by class and day of classification."""
    days = star.by("classes").groupBy("classification_id", F.to_date("last_classified").cast("string").alias("day")).agg(*_measures())
    return days.join(star.classes, "classification_id").select("categoria", "day", "files", "bytes")


def duplicates(star: Star) -> DataFrame:
    """Per canonical file: its copies and their share of all files."""
    groups = star.by("groups").where("group_id is not null").groupBy("group_id").agg(F.count("*").alias("copies"), F.count_if("is_canonical").alias("marked_canonical"))
    total = star.by().agg(F.count("*").alias("__all"))  # one row
    return groups.join(star.groups, "group_id").join(F.broadcast(total), F.lit(True)).select(
        "canonical_id", "copies", "marked_canonical", F.round(100.0 * F.col("copies") / F.col("__all"), 6).alias("percent")
    )


def integrity(star: Star) -> DataFrame:
    """Hashes that several files share, with how many and how many bytes a clean-up would free."""
    g = star.by().where("sha256 <> ''").groupBy("xxhash64", "sha256").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("b"), F.max("size_bytes").alias("m"))
    return g.where("files > 1").select("xxhash64", "sha256", "files", F.coalesce(F.col("b") - F.col("m"), F.lit(0)).cast("long").alias("bytes_to_free"))


def temporal(star: Star) -> DataFrame:
    """Files first seen, last seen and last classified per week, the change from the week before and the running total.

    The window orders weeks, not files: it runs on the aggregate.
    """
    events = ("first_seen", "last_seen", "last_classified")
    each = F.explode(F.array(*[F.struct(F.lit(e).alias("event"), F.date_trunc("WEEK", e).alias("w")) for e in events]))
    weeks = star.by().select(each.alias("e")).select("e.*").where("w is not null").groupBy("event", "w").agg(F.count("*").alias("files"))
    order = Window.partitionBy("event").orderBy("w")
    return weeks.select(
        "event", F.date_format("w", "yyyy-MM-dd").alias("week"), "files",
        (F.col("files") - F.lag("files", 1).over(order)).alias("change"), F.sum("files").over(order).alias("running"),
    )


def previews(star: Star, most: int = 200) -> DataFrame:
    """First characters of every text with name, directory and type."""
    texts = star.excerpts.select("file_id", F.substring("text_excerpt", 1, most).alias("preview"))
    facts = star.by("directories", "file_types").select("file_id", "name", "directory_id", "filetype_id").join(texts, "file_id")
    named = facts.join(star.directories.select("directory_id", "level1"), "directory_id", "left").join(star.file_types, "filetype_id", "left")
    return named.select("file_id", F.col("name").alias("file_name"), "level1", "file_type", "preview")


def size_by_type(star: Star) -> DataFrame:
    """Count and size by every combination of type, class and top directory (cube)."""
    # few combinations are left before the cube multiplies them
    level = star.directories.select("directory_id", "level1")
    small = star.by("directories", "file_types", "classes").join(level, "directory_id", "left").groupBy("filetype_id", "classification_id", "level1").agg(*_measures())
    named = small.join(star.file_types, "filetype_id").join(star.classes, "classification_id")
    sums = [F.sum("files").cast("long").alias("files"), F.sum("bytes").cast("long").alias("bytes")]
    return named.cube("file_type", "categoria", "level1").agg(F.grouping_id().cast("int").alias("subtotal"), *sums)


def kpis(star: Star, files: DataFrame) -> DataFrame:
    """Key figures as (section, item, value): totals, what waits for OCR, duplicates, contents, files per type."""
    facts = star.by("classes", "groups")
    none = star.classes.where(F.col("categoria").isin("", NO_CLASS)).select("classification_id", F.lit(True).alias("__none"))
    named = facts.join(none, "classification_id", "left").select("size_bytes", "group_id", "text_chars_extracted", "__none")
    totals = named.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes"), F.count("group_id").alias("duplicates"),
        F.count_if("__none").alias("unclassified"), F.coalesce(F.sum("text_chars_extracted"), F.lit(0)).cast("long").alias("characters"),
        F.count_if(F.col("text_chars_extracted") > 0).alias("with_text"),
    )
    pairs = ", ".join(f"'{c}', {c}" for c in totals.columns)
    out = totals.select(F.lit("totals").alias("section"), F.expr(f"stack({len(totals.columns)}, {pairs}) as (item, value)"))
    waiting = files.agg(F.count_if(needs_ocr()).alias("value")).select(F.lit("totals").alias("section"), F.lit("ocr_pending").alias("item"), "value")
    kinds = file_types(star).select(F.lit("types").alias("section"), F.col("file_type").alias("item"), F.col("files").alias("value"))
    return out.unionByName(waiting).unionByName(kinds)
