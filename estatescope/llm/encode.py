"""Whole-corpus encoding by a public byte-level tokenizer.

A global shuffle of distinct words. Texts are cut into pre-tokens in the JVM;
blocks of documents, the unit of pre-aggregation, list each distinct pre-token
once with its slot and keep the positions as slot numbers. The (word, block, slot)
rows are shuffled by word, so that each distinct word of the corpus is encoded
once, its ids go back to the blocks, and every block puts the ids of its
documents together by position. A frequent word sends at most one row per block,
so no word can weigh on one task more than a block count.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm.pretokens import pretokens
from estatescope.llm.vocabulary import BYTE_BPE, FOLDER, encoding, token_bytes

#: Characters after which a block of documents is closed (a longer document is a block of its own).
BLOCK_CHARS = 8_000_000
#: Documents per Arrow batch between JVM and Python.
BATCH_ROWS = 2000


def _blocks(key: str, block_chars: int):
    """Arrow map: (key, words) batches to one row per block."""

    def close(keys: list, parts: list, seq: Iterator[int]) -> pa.RecordBatch:
        lens = np.concatenate([np.asarray(pc.list_value_length(p)) for p in parts]).astype(np.int32)
        coded = pa.concat_arrays([p.flatten() for p in parts]).dictionary_encode()
        slots = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        block = (TaskContext.get().partitionId() << 32) + next(seq)
        packed = pa.compress(slots.tobytes(), "zstd", asbytes=True) if len(slots) else b""
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(lens)], pa.int32()), pa.concat_arrays(keys)),
                pa.array([lens.tolist()], pa.list_(pa.int32())),
                pa.array([packed], pa.binary()),
                pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string())),
            ],
            ["block", "keys", "lens", "slots", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = itertools.count()
        keys, parts, chars = [], [], 0
        for batch in batches:
            words = batch.column("words").cast(pa.list_(pa.large_string()))
            size = np.add.accumulate(np.asarray(batch.column("chars")).astype(np.int64))
            ids = batch.column(key)
            start, base = 0, 0
            while start < len(ids):
                stop = min(len(ids), max(start + 1, int(np.searchsorted(size, base + block_chars - chars, "right"))))
                keys.append(ids.slice(start, stop - start))
                parts.append(words.slice(start, stop - start))
                chars += int(size[stop - 1]) - base
                start, base = stop, int(size[stop - 1])
                if chars >= block_chars or start < len(ids):
                    yield close(keys, parts, seq)
                    keys, parts, chars = [], [], 0
        if keys:
            yield close(keys, parts, seq)

    return run


def _encode_words(folder: str, name: str, counts: bool):
    """Arrow map over rows sorted by word: each distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = encoding(folder, name)._core_bpe.encode_single_piece
        last, ids = None, None
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            table = []
            for word in coded.dictionary.to_pylist():
                if word != last:
                    last, ids = word, piece(word.encode())
                table.append(len(ids) if counts else ids)
            made = pa.array(table, pa.int32() if counts else pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("slot"), made.take(coded.indices)], ["block", "slot", "ids"]
            )

    return run


def _gather(key: str, counts: bool):
    """Arrow cogroup of a block and its encoded words: rows of (key, ids) or (key, n_tokens)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left.column("keys").combine_chunks().flatten()
        lens = np.asarray(left.column("lens").combine_chunks().flatten()).astype(np.int64)
        raw = left.column("slots")[0].as_py()
        total = int(lens.sum())
        slots = np.frombuffer(pa.decompress(raw, total * 4, "zstd", asbytes=True), np.int32) if total else np.zeros(0, np.int32)
        ends = np.add.accumulate(lens)
        where = right.column("slot").to_numpy()
        values = right.column("ids").combine_chunks()
        if counts:
            size = np.zeros(len(where), np.int64)
            size[where] = values.to_numpy()
            sums = np.concatenate([[0], np.add.accumulate(size[slots])])
            made = sums[ends] - sums[ends - lens]
            return pa.table({key: keys, "n_tokens": pa.array(made, pa.int64())})
        flat = values.flatten().to_numpy()
        length = np.zeros(len(where), np.int64)
        offset = np.zeros(len(where), np.int64)
        own = np.asarray(pc.list_value_length(values)).astype(np.int64)
        length[where] = own
        offset[where] = np.add.accumulate(own) - own
        n = length[slots]
        at = np.concatenate([[0], np.add.accumulate(n)])
        ids = flat[np.repeat(offset[slots] - at[:-1], n) + np.arange(at[-1])] if total else np.zeros(0, np.int32)
        bounds = np.concatenate([[0], at[ends]]).astype(np.int32)
        return pa.table({key: keys, "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))})

    return run


def _encoded(docs: DataFrame, key: str, text: str, counts: bool, folder: str, name: str, block_chars: int) -> DataFrame:
    spark = docs.sparkSession
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    try:
        words = docs.select(
            F.col(key).cast("long").alias(key),
            pretokens(F.col(text)).alias("words"),
            F.coalesce(F.length(text), F.lit(0)).alias("chars"),
        )
        blocks = workspace.materialize(
            words.mapInArrow(
                _blocks(key, block_chars), "block long, keys array<long>, lens array<int>, slots binary, words array<string>"
            ),
            "blocks",
        )
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    listed = blocks.select("block", F.posexplode("words").alias("slot", "word"))
    kind = "int" if counts else "array<int>"
    ids = (
        listed.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode_words(folder, name, counts), f"block long, slot int, ids {kind}")
    )
    out = f"{key} long, n_tokens long" if counts else f"{key} long, ids array<int>"
    return (
        blocks.drop("words").groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_gather(key, counts), out)
    )


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, name: str = BYTE_BPE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(key, ids) with the token ids of every document's whole text, without special tokens.

    An empty text and a null text give an empty list. Rows are neither merged nor
    dropped: a document given twice comes out twice, a null key stays null. Only the
    key and the text are read, so other columns cannot clash.
    """
    return _encoded(docs, key, text, False, folder, name, block_chars)


def token_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, name: str = BYTE_BPE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(key, n_tokens) of every document, by the same shuffle with counts in place of ids."""
    return _encoded(docs, key, text, True, folder, name, block_chars)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", folder: str = FOLDER, name: str = BYTE_BPE) -> DataFrame:
    """(key, text) back from ids, by joining the token-byte table; an empty or null list gives ''.

    The table is the vocabulary file, of fixed size (about 50,000 rows, under 1 MB), so every task holds it and
    the join is a look-up by id, without a shuffle. Ids beyond the table give nothing; bytes that are no UTF-8 (cut inside a
    character) are replaced. A row given twice comes out twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(folder, name)
        size = np.array([len(b) for b in table] + [0], np.int64)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        raw = np.frombuffer(b"".join(table), np.uint8)
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                column = batch.column(ids)
                token = np.asarray(column.flatten().fill_null(-1)).astype(np.int64)
                token = np.where((token < 0) | (token >= len(table)), len(table), token)
                n = size[token]
                at = np.concatenate([[0], np.cumsum(n)])
                data = raw[np.repeat(start[token] - at[:-1], n) + np.arange(at[-1])]
                ends = at[np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column).fill_null(0)))])]
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())], [key, "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
