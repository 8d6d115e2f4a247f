"""Files linked directly or through others, by the connected components of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope.operators.components import components


def linked_files(files: DataFrame, match_pairs: DataFrame) -> DataFrame:
    """(group_id, id) of every file linked to another by canonical_id or a match pair.

    Links to ids that are not in ``files`` and links with a null end do not count,
    whatever the pair's other columns or is_canonical say.
    """
    ids = files.select("id").where("id is not null").distinct()
    pointers = files.select(F.col("id").alias("a"), F.col("canonical_id").alias("b")).where("a is not null and a <> b")
    # the left end of a pointer is a file by construction; only the other end needs a look-up
    known = pointers.join(ids.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    matched = match_pairs.select(F.col("file_id_a").alias("a"), F.col("file_id_b").alias("b")).where("a <> b").distinct()
    matched = matched.join(ids.select(F.col("id").alias("a")), "a", "left_semi")
    matched = matched.join(ids.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    return components(known.union(matched)).select("group_id", "id")
