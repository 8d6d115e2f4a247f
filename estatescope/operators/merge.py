"""Writing results back: a stage takes a snapshot and a delta and gives the next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scan_upsert(files: DataFrame, scanned: DataFrame, now: Column, rearm_on_change: bool = False) -> DataFrame:
    """Merge a new scan into the inventory by full_path.

    Unknown paths are added. A known path takes name, size, modification year and
    ``now`` as last_seen only if size or year differ (a null on either side is no
    difference); hashes stay unless ``rearm_on_change`` asks to hash again. Paths not
    scanned stay. scanned: full_path, file_name, file_type, size_bytes,
    creation_year, modification_year, depth, is_pdf.
    """
    new = scanned.select("full_path", *[F.col(c).alias(f"n_{c}") for c in scanned.columns if c != "full_path"], F.lit(True).alias("n_row"))
    both = files.withColumn("o_row", F.lit(True)).join(new, "full_path", "full_outer")
    changed = F.coalesce(
        F.col("o_row") & F.col("n_row")
        & ((F.col("size_bytes") != F.col("n_size_bytes")) | (F.col("modification_year") != F.col("n_modification_year"))),
        F.lit(False),
    )
    added = F.col("o_row").isNull()
    out = {}
    for c in files.columns:
        if c in ("file_name", "size_bytes", "modification_year"):
            out[c] = F.when(changed | added, F.col(f"n_{c}")).otherwise(F.col(c))
        elif c == "last_seen":
            out[c] = F.when(changed | added, now).otherwise(F.col(c))
        elif c == "first_seen":
            out[c] = F.when(added, now).otherwise(F.col(c))
        elif c == "hash_pending":
            out[c] = F.when(added, F.lit(True)).when(changed & F.lit(rearm_on_change), F.lit(True)).otherwise(F.col(c))
        elif c == "is_canonical":
            out[c] = F.when(added, F.lit(False)).otherwise(F.col(c))
        elif c != "full_path" and f"n_{c}" in new.columns:
            out[c] = F.when(added, F.col(f"n_{c}")).otherwise(F.col(c))
        else:
            out[c] = F.col(c)
    action = F.when(added, "insert").when(changed, "update").otherwise("keep")
    return both.select(*[v.alias(k) for k, v in out.items()], action.alias("action"))


def apply_delta(files: DataFrame, delta: DataFrame, key: str = "id", keep_old_on_null: bool = True, **fixed: Column) -> DataFrame:
    """Snapshot with the columns of ``delta`` put in by key; ``fixed`` columns are set on the rows it names.

    A null in the delta keeps the old value unless ``keep_old_on_null`` is off. The
    delta's first row of a key would be arbitrary, so keys must be unique in it.
    """
    names = [c for c in delta.columns if c != key]
    marked = delta.select(key, *[F.col(c).alias(f"__d_{c}") for c in names], F.lit(True).alias("__hit"))
    both = files.join(marked, key, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = []
    for c in dict.fromkeys([*files.columns, *names, *fixed]):
        old = F.col(c) if c in files.columns else F.lit(None)
        if c in names:
            new = F.col(f"__d_{c}")
            out.append((F.coalesce(new, old) if keep_old_on_null else F.when(hit, new).otherwise(old)).alias(c))
        elif c in fixed:
            out.append(F.when(hit, fixed[c]).otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return both.select(*out)


def apply_hashes(files: DataFrame, hashes: DataFrame) -> DataFrame:
    """Put (id, xxhash64, sha256) in and take the rows out of the hash queue."""
    return apply_delta(files, hashes, hash_pending=F.lit(False))


def apply_ocr_flags(files: DataFrame, flags: DataFrame) -> DataFrame:
    """Put (id, ocr_needed) in; an undecided check changes nothing."""
    return apply_delta(files, flags)


def mark_ocr_needed(files: DataFrame, ids: DataFrame) -> DataFrame:
    """ocr_needed becomes true for the ids given."""
    return apply_delta(files, ids.select("id").distinct(), ocr_needed=F.lit(True))


def apply_texts(files: DataFrame, texts: DataFrame) -> DataFrame:
    """Put (id, text_excerpt, text_chars_extracted) in."""
    return apply_delta(files, texts, keep_old_on_null=False)


def apply_captions(files: DataFrame, captions: DataFrame, now: Column) -> DataFrame:
    """Put (id, text_excerpt) of captions in; the character count is left as it is."""
    return apply_delta(files, captions, last_seen=now)


def apply_classes(files: DataFrame, classes: DataFrame, now: Column) -> DataFrame:
    """Put (id, categoria, anio, proyecto) in and note when."""
    return apply_delta(files, classes, keep_old_on_null=False, last_classified=now)


def apply_flags_by_path(files: DataFrame, flags: DataFrame) -> DataFrame:
    """Put ocr_needed in by full_path."""
    return apply_delta(files, flags, key="full_path")


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str, tie: str) -> DataFrame:
    """Target with the rows whose key it doesn't have; of several new rows of a key the least ``tie`` wins."""
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(tie).alias("__tie"))
    fresh = rows.join(first, (rows[key] == first[key]) & (rows[tie] == first["__tie"]), "left_semi")
    fresh = fresh.join(target.select(key).distinct(), key, "left_anti").select(*rows.columns)
    return target.unionByName(fresh)


def changed_only(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Rows whose hashes or last_seen differ from what is published (two nulls are equal), or that are new."""
    same = ["xxhash64", "sha256", "last_seen"]
    old = published.select(F.col("file_id").alias("id"), *[F.col(c).alias(f"__{c}") for c in same])
    cond = rows["id"] == old["id"]
    for c in same:
        cond &= rows[c].eqNullSafe(old[f"__{c}"])
    return rows.join(old, cond, "left_anti")


def ensure_columns(df: DataFrame, **types: str) -> DataFrame:
    """``df`` with the named columns added as nulls where missing."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns])
