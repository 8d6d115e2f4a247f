"""Near-duplicate texts: dart signatures, banded joining, exact check.

Identical texts are one class; the smallest id represents it. Representatives get a
signature over their distinct word shingles (weight 1 each), its coordinates are
joined in bands, and every candidate pair is checked exactly on the shingle sets.
With ``rows_per_band`` r and ``bands`` b a pair of similarity s becomes a candidate with
probability 1 - (1 - s^r)^b.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm.components import components
from estatescope.llm.dart import mix64, signatures

_BATCH_TEXTS = 1000
_WORD = re.compile("[ \t\n\f\r]+")


def words_of(text: str) -> list[bytes]:
    """Lower-case words between spaces, tabs, line feeds, carriage returns and form feeds."""
    if "\x0b" in text:  # bytes.split would also cut here
        return [w.encode() for w in _WORD.split(text.lower()) if w]
    return text.lower().encode().split()


def shingle_sets(texts: list[str], width: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text of at least ``least_words`` words, sorted by row and hash."""
    words = [words_of(t) for t in texts]
    words = [w if len(w) >= max(least_words, width) else [] for w in words]
    n = np.array([len(w) for w in words], np.int64)
    coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    table = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = table[coded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(texts)), n)
    combined = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        combined = mix64(combined * np.uint64(3) + hashes[k : len(hashes) - width + 1 + k])
    inside = row[: len(combined)] == row[width - 1 :]
    row, combined = row[: len(combined)][inside], combined[inside]
    order = np.lexsort((combined, row))
    row, combined = row[order], combined[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (combined[1:] != combined[:-1])
    return row[new], combined[new]


def _sign(width: int, least_words: int, bands: int, rows_per_band: int):
    k = bands * rows_per_band

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH_TEXTS):
                batch = whole.slice(start, _BATCH_TEXTS)
                ids = np.asarray(batch.column("rep"))
                row, shingle = shingle_sets(batch.column("text").to_pylist(), width, least_words)
                size = np.bincount(row, minlength=len(ids))
                keep = np.flatnonzero(size)
                if not len(keep):
                    continue
                ranks = signatures(row, shingle, np.ones(len(row)), len(ids), k)[keep].view(np.uint64)
                key = np.zeros((len(keep), bands), np.uint64)
                for r in range(rows_per_band):
                    key = mix64(key * np.uint64(5) + ranks[:, r::rows_per_band])
                key = mix64(key + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                flat = (shingle & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                bounds = np.concatenate([[0], np.add.accumulate(size[keep])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[keep], pa.int64()),
                        pa.array(size[keep], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, bands), pa.int32()), pa.array(key.ravel())),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    ],
                    ["rep", "n", "bands", "shingles"],
                )

    return run


class NearDuplicates:
    """Near-duplicate pairs of the texts of ``df``.

    key, text: columns read (others are ignored, so their names cannot clash)
    width: words per shingle; threshold: least Jaccard similarity of the sets of distinct shingles
    least_words: shorter texts have no partners (neither have null and empty ones)
    bands, rows_per_band: banding of the signature

    Ids given twice count once; rows with a null id or text take no part.
    """

    def __init__(
        self, df: DataFrame, key: str = "id", text: str = "text_excerpt", width: int = 5, threshold: float = 0.8,
        least_words: int = 5, bands: int = 16, rows_per_band: int = 4,
    ):
        texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
        # n words take at least 2n - 1 characters
        texts = texts.where(F.col("id").isNotNull() & (F.length("text") >= 2 * max(least_words, width) - 1))
        content = texts.select("id", F.unhex(F.md5("text")).alias("content"))
        classes = content.groupBy("content").agg(F.min("id").alias("rep"))
        #: (id, rep) of every text long enough
        self.members = workspace.materialize(content.join(classes, "content").select("id", "rep").distinct(), "members")
        reps = self.members.where("id = rep").select("id")
        unique = texts.join(reps.hint("shuffle_hash"), "id", "left_semi").select(F.col("id").alias("rep"), "text")
        signed = unique.mapInArrow(
            _sign(width, least_words, bands, rows_per_band), "rep long, n int, bands array<long>, shingles array<int>"
        )
        self._signed = workspace.materialize(signed, "signed")
        self._threshold = threshold

    def candidates(self) -> DataFrame:
        """Distinct (a, b), a < b, of representatives that share a band and whose set sizes allow the threshold."""
        rows = self._signed.select("rep", "n", F.explode("bands").alias("band"))
        left, right = rows.toDF("a", "n_a", "band"), rows.toDF("b", "n_b", "band")
        t = self._threshold
        close = (F.col("a") < F.col("b")) & (F.col("n_a") >= t * F.col("n_b")) & (F.col("n_b") >= t * F.col("n_a"))
        return left.join(right, (left.band == right.band) & close).select("a", "b").distinct()

    def class_pairs(self) -> DataFrame:
        """(a, b, similarity) of representatives with at least the threshold, checked on the whole sets."""
        sets = self._signed.select("rep", "shingles")
        found = self.candidates()
        both = found.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        joined = both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("sum"))
        similarity = F.col("shared") / (F.col("sum") - F.col("shared"))
        similar = joined.withColumn("similarity", similarity).where(F.col("similarity") >= self._threshold)
        return similar.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))

    def pairs(self) -> DataFrame:
        """(id_a, id_b) of all ids whose texts differ and are similar enough; the smaller id first.

        Copies are put back by two joins on the class, after everything else is done.
        """
        pairs = self.class_pairs().select("a", "b")
        left, right = self.members.toDF("x", "a"), self.members.toDF("y", "b")
        both = pairs.join(left, "a").join(right, "b")
        return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))

    def groups(self) -> DataFrame:
        """(id, group_id, class_id, links): every text with its class of exact copies, the number of its
        similar classes and the group of all texts connected to it; group_id is the smallest id."""
        pairs = workspace.materialize(self.class_pairs().select("a", "b"), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        merged = components(pairs).select(F.col("id").alias("rep"), "group_id").join(ends, "rep", "left")
        return self.members.join(merged, "rep", "left").select(
            "id", F.coalesce("group_id", "rep").alias("group_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")
        )
