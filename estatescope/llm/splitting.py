"""Cutting long texts into pieces within a token limit, at natural boundaries.

Token lengths are summed to offsets; the offsets at which a cut is natural form a
sorted array per kind (paragraph, sentence, line, word). Each piece ends at the
last boundary under the limit, found by binary search from the best kind to the
least, and the next piece starts the overlap further back, at a boundary again.
Where a text has no boundary in reach the cut is hard, between two characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope.llm.vocabulary import BYTE_BPE, FOLDER, encoding, token_bytes

LIMIT = 2048
OVERLAP = 128
#: A boundary counts as within reach if the piece keeps at least this part of the limit.
LEAST_FILL = 0.5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def boundaries(text: bytes, starts: np.ndarray) -> list[np.ndarray]:
    """Sorted token numbers before which a cut is natural: paragraph, sentence, line, word.

    Only starts of pre-tokens count, so a piece cut there has the tokens it had
    within the text.
    """
    raw = np.frombuffer(text, np.uint8)
    here, before = raw[starts[1:]], raw[starts[1:] - 1]
    word = ((here == 32) & ~_SPACE[before]) | (~_SPACE[here] & (before == 10))
    line = word & (before == 10)
    second = raw[np.maximum(starts[1:] - 2, 0)]
    para = line & ((second == 10) | (second == 13))
    stop = word & (_STOP[before] | line & _STOP[second])
    return [np.flatnonzero(kind) + 1 for kind in (para, stop, line, word)]


def spans(text: str, limit: int, overlap: int, folder: str = FOLDER, name: str = BYTE_BPE) -> list[tuple[int, int, int, int]]:
    """(first byte, end byte, first token, end token) of the pieces of one text."""
    ids = encoding(folder, name).encode_ordinary(text)
    raw = text.encode()
    if len(ids) <= limit:
        return [(0, len(raw), 0, len(ids))]
    table = token_bytes(folder, name)
    starts = np.concatenate([[0], np.add.accumulate([len(table[i]) for i in ids])])
    kinds = boundaries(raw, starts[:-1])
    # a hard cut must not fall inside a character
    whole = np.flatnonzero((np.frombuffer(raw, np.uint8)[starts[:-1]] & 0xC0) != 0x80)

    def last(array: np.ndarray, low: int, high: int) -> int | None:
        k = int(np.searchsorted(array, high, "right")) - 1
        return int(array[k]) if k >= 0 and array[k] > low else None

    out, start = [], 0
    while True:
        if len(ids) - start <= limit:
            out.append((int(starts[start]), len(raw), start, len(ids)))
            return out
        end, reach = start + limit, start + int(limit * LEAST_FILL)
        cut = next((c for kind in kinds if (c := last(kind, reach, end)) is not None), None)
        if cut is None:
            cut = last(kinds[-1], start, end) or last(whole, start, end) or end
        out.append((int(starts[start]), int(starts[cut]), start, cut))
        back = max(cut - overlap, start + 1)
        k = int(np.searchsorted(kinds[-1], back))
        after = int(kinds[-1][k]) if k < len(kinds[-1]) and kinds[-1][k] <= cut else None
        if after is None:
            k = int(np.searchsorted(whole, back))
            after = int(whole[k]) if k < len(whole) and whole[k] <= cut else cut
        start = after


def _cut(key: str, limit: int, overlap: int, folder: str, name: str, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(key).to_pylist(), batch.column("__text").to_pylist()):
                pieces = spans(text, limit, overlap, folder, name)
                raw = text.encode() if with_text else b""
                rows += [
                    (doc, k, len(pieces), a, b, raw[x:y].decode("utf-8", "replace") if with_text else None)
                    for k, (x, y, a, b) in enumerate(pieces)
                ]
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], [key, "piece", "pieces", "first_token", "end_token", "text"]
            )

    return run


def split(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP,
    folder: str = FOLDER, name: str = BYTE_BPE, with_text: bool = True,
) -> DataFrame:
    """(key, piece, pieces, first_token, end_token, text) of every piece of the texts over the limit.

    Tokens are numbered within the whole text; neighbouring pieces share
    ``first_token`` of the later up to ``end_token`` of the earlier, at most
    ``overlap`` tokens. A text within the limit, an empty or a null text needs no
    cut and has no row. A token has at least one byte, so texts of no more bytes
    than the limit are left out before they are tokenized; every other text is
    read whole. A document given twice comes out twice.
    """
    if not 0 <= overlap < limit * LEAST_FILL:
        raise ValueError("the overlap must be less than half the limit")
    long = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__text")).where(F.octet_length("__text") > limit)
    schema = f"{key} long, piece int, pieces int, first_token long, end_token long, text string"
    return long.mapInArrow(_cut(key, limit, overlap, folder, name, with_text), schema).where("pieces > 1")
