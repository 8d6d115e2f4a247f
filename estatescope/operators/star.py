"""Star schema: dimensions, facts and their upserts.

Surrogate keys are hashes of the natural key, so no global order is needed; facts get
theirs by looking the natural key up in the dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope.functions.cleaning import safe_bool, safe_int, safe_str
from estatescope.functions.paths import directory_levels, parts, path_name, path_parent

#: What stands for a missing type and class in the dimensions.
NO_TYPE, NO_CLASS = "tipo desconocido", "sin clasificación"


def surrogate(natural: Column) -> Column:
    """Stable key of a natural key; null for null."""
    return F.when(natural.isNotNull(), F.xxhash64(natural))


def dim_directory(files: DataFrame, key: str = "full_path") -> DataFrame:
    """(directory_id, path, name, parent_id, parent_path, depth, level1..level5) of every path and all its ancestors.

    With ``key='full_path'`` every file is a leaf row too; ``key='parent'`` keeps
    directories only. The root is no row; the first component has no parent.
    """
    path = F.col("full_path") if key == "full_path" else path_parent(F.col("full_path"))
    paths = files.select(path.alias("p")).where("p is not null").distinct()
    split = paths.select(parts(F.col("p")).alias("a"))
    every = split.select(F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.size("a"), F.lit(2))), lambda i: F.array_join(F.slice("a", 1, i), "/"))).alias("path"))
    known = every.where("path not in ('', '.', '/')").distinct()
    # every ancestor of a row is a row, so a parent's key needs no look-up
    parent = path_parent(F.col("path"))
    return known.select(
        surrogate(F.col("path")).alias("directory_id"), "path", path_name(F.col("path")).alias("name"),
        surrogate(parent).alias("parent_id"), parent.alias("parent_path"),
        F.size(parts(F.col("path"))).alias("depth"), *directory_levels(F.col("path")),
    )


def directory_children(directories: DataFrame) -> DataFrame:
    """(directory_id, path, parent, children): every directory with its parent's name and the number of rows right below
    it, by joining the dimension with itself."""
    above = directories.select(F.col("directory_id").alias("parent_id"), F.col("name").alias("parent"))
    below = directories.where("parent_id is not null").groupBy(F.col("parent_id").alias("directory_id")).agg(F.count("*").alias("children"))
    joined = directories.select("directory_id", "path", "parent_id").join(above, "parent_id", "left").join(below, "directory_id", "left")
    return joined.select("directory_id", "path", "parent", F.coalesce("children", F.lit(0)).cast("long").alias("children"))


def dim_filetype(files: DataFrame) -> DataFrame:
    """(filetype_id, file_type): the distinct cleaned file types."""
    kind = files.select(safe_str(F.col("file_type"), NO_TYPE).alias("file_type")).distinct()
    return kind.select(surrogate(F.col("file_type")).alias("filetype_id"), "file_type")


def dim_classification(files: DataFrame) -> DataFrame:
    """(classification_id, categoria): the distinct cleaned classes."""
    kind = files.select(safe_str(F.col("categoria"), NO_CLASS).alias("categoria")).distinct()
    return kind.select(surrogate(F.col("categoria")).alias("classification_id"), "categoria")


def dim_canonical_group(files: DataFrame) -> DataFrame:
    """(group_id, canonical_id): one row per canonical file that others point to."""
    ids = files.select("canonical_id").where("canonical_id is not null").distinct()
    return ids.select(surrogate(F.col("canonical_id")).alias("group_id"), "canonical_id")


def fact_files(files: DataFrame) -> DataFrame:
    """Fact rows of the hashed files, keyed by file_id, with natural dimension keys.

    A missing flag is_canonical counts as true, a missing character count as 0; missing digests stay missing.
    """
    ready = files.where("hash_pending = false")
    return ready.select(
        F.col("id").alias("file_id"), safe_str(F.col("file_name")).alias("name"), F.col("full_path").alias("directory_path"),
        safe_str(F.col("file_type"), NO_TYPE).alias("file_type"), safe_str(F.col("categoria"), NO_CLASS).alias("categoria"), "canonical_id",
        "size_bytes", "creation_year", "modification_year", "depth",
        safe_bool(F.col("is_pdf")).alias("is_pdf"), safe_bool(F.col("ocr_needed")).alias("ocr_needed"), safe_bool(F.col("is_canonical"), True).alias("is_canonical"),
        safe_str(F.col("xxhash64"), None).alias("xxhash64"), safe_str(F.col("sha256"), None).alias("sha256"),
        safe_int(F.col("text_chars_extracted"), 0).alias("text_chars_extracted"),
        "first_seen", "last_seen", "last_classified", safe_str(F.col("proyecto")).alias("proyecto"), safe_str(F.col("anio")).alias("anio"),
    )


def fact_file_excerpts(files: DataFrame) -> DataFrame:
    """(file_id, text_excerpt) of the hashed files that have a text."""
    return files.where("hash_pending = false and text_excerpt <> ''").select(F.col("id").alias("file_id"), "text_excerpt")


#: Tables of the dimensions: natural key in the facts, in the dimension, and surrogate key.
KEYS = {
    "directories": ("directory_path", "path", "directory_id"), "file_types": ("file_type", "file_type", "filetype_id"),
    "classes": ("categoria", "categoria", "classification_id"), "groups": ("canonical_id", "canonical_id", "group_id"),
}
TABLES = ("facts", "excerpts", *KEYS)


def keyed_facts(facts: DataFrame, **dimensions: DataFrame) -> DataFrame:
    """Facts with the keys of the dimensions given, looked up by their natural values, in place of all of these."""
    for name, dim in dimensions.items():
        natural, own, key = KEYS[name]
        facts = facts.join(dim.select(key, F.col(own).alias(natural)), natural, "left")
    keys = [KEYS[name][2] for name in dimensions]
    return facts.select("file_id", *keys, *[c for c in facts.columns if c not in ("file_id", *keys, *(k[0] for k in KEYS.values()))])


@dataclass(frozen=True)
class Star:
    """The tables of the star schema; ``facts`` point to the dimensions by key.

    natural: the facts with natural values, where the schema is built and not yet written
    """

    facts: DataFrame
    excerpts: DataFrame
    directories: DataFrame
    file_types: DataFrame
    classes: DataFrame
    groups: DataFrame
    natural: DataFrame | None = None

    def by(self, *dimensions: str) -> DataFrame:
        """Facts with the keys of some dimensions at least, without looking up the others."""
        return self.facts if self.natural is None else keyed_facts(self.natural, **{n: getattr(self, n) for n in dimensions})

    def beside(self, dimension: str, *columns: str) -> DataFrame:
        """Facts with columns of one dimension, joined by its key, or by what the key stands for before it is looked up."""
        natural, own, key = KEYS[dimension]
        dim = getattr(self, dimension)
        if self.natural is None:
            return self.facts.join(dim.select(key, *columns), key, "left")
        return self.natural.join(dim.select(F.col(own).alias(natural), *columns), natural, "left")


def build(files: DataFrame) -> Star:
    """The star schema of an inventory."""
    ready, natural = files.where("hash_pending = false"), fact_files(files)
    made = (dim_directory(ready), dim_filetype(ready), dim_classification(ready), dim_canonical_group(ready))
    return Star(keyed_facts(natural, **dict(zip(KEYS, made))), fact_file_excerpts(files), *made, natural)


def publish(files: DataFrame, folder: str) -> Star:
    """Write the star schema of an inventory below ``folder``, replacing what is there, and return the written tables."""
    made, spark = build(files), files.sparkSession
    for name in TABLES:
        getattr(made, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    return Star(*(spark.read.parquet(f"{folder}/{name}") for name in TABLES))


def upsert_facts(published: DataFrame, rows: DataFrame) -> DataFrame:
    """Published facts with ``rows`` merged in by file_id; a known row keeps its name."""
    new = rows.select(F.col("file_id"), *[F.col(c).alias(f"n_{c}") for c in rows.columns if c != "file_id"], F.lit(True).alias("n_row"))
    both = published.withColumn("o_row", F.lit(True)).join(new, "file_id", "full_outer")
    out = [F.col("file_id")]
    for c in published.columns:
        if c == "file_id":
            continue
        if c == "name":
            out.append(F.when(F.col("o_row"), F.col(c)).otherwise(F.col(f"n_{c}")).alias(c))
        elif f"n_{c}" in new.columns:
            out.append(F.when(F.col("n_row"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)
