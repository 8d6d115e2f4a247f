"""Groups of files with one content and the canonical file of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope import workspace


#: Members up to which a group's paths are listed in one row.
MOST_LISTED = 100


def _groups(files: DataFrame) -> DataFrame:
    g = files.where("sha256 is not null").groupBy("xxhash64", "sha256").agg(F.count("*").alias("total"), F.min("full_path").alias("first_path"))
    return g.where("total > 1")


def _members(files: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select(F.col("xxhash64").alias("__x"), F.col("sha256").alias("__s"))
    return files.join(g, (F.col("sha256") == F.col("__s")) & F.col("xxhash64").eqNullSafe(F.col("__x")), "left_semi").select("xxhash64", "sha256", "full_path")


def duplicate_groups(files: DataFrame) -> DataFrame:
    """Groups of two or more files of one (xxhash64, sha256), the largest first.

    total, first_path and, up to MOST_LISTED files, the sorted paths joined by '; '. The files of larger groups are
    rows of :func:`duplicate_members`.
    """
    groups = _groups(files)
    listed = _members(files, groups.where(F.col("total") <= MOST_LISTED)).groupBy("xxhash64", "sha256").agg(F.array_join(F.array_sort(F.collect_list("full_path")), "; ").alias("paths"))
    l = listed.select(F.col("xxhash64").alias("__x"), F.col("sha256").alias("__s"), "paths")  # noqa: E741
    out = groups.join(l, (F.col("sha256") == F.col("__s")) & F.col("xxhash64").eqNullSafe(F.col("__x")), "left")
    name = F.element_at(F.split("first_path", "/"), -1)
    return out.select("xxhash64", "sha256", "total", "first_path", name.alias("first_name"), "paths").orderBy(F.desc("total"), "sha256", "xxhash64")


def duplicate_members(files: DataFrame) -> DataFrame:
    """(xxhash64, sha256, full_path) of every file of every group, whatever its size."""
    return _members(files, _groups(files))


def duplicate_summary(files: DataFrame) -> DataFrame:
    """One row: number of groups, files in them, size of the largest and its first file's path."""
    groups = files.where("sha256 is not null").groupBy("xxhash64", "sha256").agg(
        F.count("*").alias("n"), F.min("full_path").alias("first_path")
    ).where("n > 1")
    largest = F.max(F.struct("n", "first_path"))
    return groups.agg(
        F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("files"),
        largest["n"].alias("largest"), largest["first_path"].alias("largest_path"),
    )


def hash_canonical(files: DataFrame) -> DataFrame:
    """(id, is_canonical, canonical_id): the smallest id of every sha256 is canonical, the others point to it.

    Rows without a digest keep what they have. The minimum is an aggregate joined
    back, so the copies of one content never meet in one task.
    """
    least = files.where("sha256 is not null").groupBy("sha256").agg(F.min("id").alias("__low"))
    both = files.select("id", "sha256", "is_canonical", "canonical_id").join(least, "sha256", "left")
    hashed = F.col("sha256").isNotNull()
    return both.select(
        "id",
        F.when(hashed, F.col("id") == F.col("__low")).otherwise(F.col("is_canonical")).alias("is_canonical"),
        F.when(hashed & (F.col("id") != F.col("__low")), F.col("__low")).when(~hashed, F.col("canonical_id")).alias("canonical_id"),
    )


def preference() -> Column:
    """Struct whose maximum is the preferred file: text-bearing PDF, larger, later, shallower, smaller id."""
    zero = F.lit(0)
    return F.struct(
        (F.coalesce(F.col("is_pdf"), F.lit(False)) & ~F.coalesce(F.col("ocr_needed"), F.lit(False))).alias("q"),
        F.coalesce("size_bytes", zero).alias("s"), F.coalesce("modification_year", zero).alias("y"),
        (-F.coalesce("depth", zero)).alias("d"), (-F.col("id")).alias("i"),
    )


def choose_canonical(files: DataFrame, group: str = "sha256") -> DataFrame:
    """(group, members, canonical_id): the preferred file of every group."""
    best = files.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("members"), F.max(preference()).alias("b"))
    return best.select(group, "members", (-F.col("b.i")).alias("canonical_id"))


def compress_pointers(files: DataFrame) -> DataFrame:
    """(id, root): where the canonical_id chain of every pointing file ends.

    Pointer doubling: every round joins the pointers with themselves, so chains of
    length n take log n rounds. A pointer to no file is none; a circle ends at its
    smallest id.
    """
    ids = files.select("id").where("id is not null")
    jumps = files.where("canonical_id is not null and canonical_id <> id").select("id", F.col("canonical_id").alias("to"))
    jumps = jumps.join(ids.select(F.col("id").alias("to")), "to", "left_semi").select("id", "to")
    # low: the smallest id met on the way, which names a circle
    state = workspace.materialize(jumps.select("id", "to", F.least("id", "to").alias("low")), "pointers")
    for _ in range(max(1, state.count().bit_length())):
        onward = state.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("low").alias("low2"))
        joined = state.join(onward, "to", "left").select(
            "id", F.coalesce("to2", "to").alias("to"), F.least("low", F.coalesce("low2", "low")).alias("low")
        )
        after = workspace.materialize(joined, "pointers")
        workspace.discard(state)
        state = after
    # only in a circle does the end still point on
    circle = state.select(F.col("id").alias("to"), F.lit(True).alias("on"))
    return state.join(circle, "to", "left").select("id", F.when(F.col("on"), F.col("low")).otherwise(F.col("to")).alias("root"))
