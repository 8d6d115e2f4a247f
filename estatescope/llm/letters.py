"""Likelihood of a spelling: a character trigram model of the corpus's words.

Every distinct word counts once, so the model tells how words are spelt and not how
often they are used. Its size is fixed by the alphabet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters told apart; the end of a word comes first, all other characters last.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_SIZE = len(ALPHABET) + 2
_AT = {c: i + 1 for i, c in enumerate(ALPHABET)}
#: Weight of the shorter context.
BACK_OFF = 5.0


def codes(word: str) -> list[int]:
    return [_AT.get(c, _SIZE - 1) for c in word]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SIZE**3, np.int64)
    for batch in batches:
        flat: list[int] = [0]
        for word in batch.column("word").to_pylist():
            flat += [0, *codes(word)]
        x = np.array([*flat, 0], np.int64)
        at = (x[:-2] * _SIZE + x[1:-1]) * _SIZE + x[2:]
        # a word begins after two ends and stops at one
        total += np.bincount(at[x[1:-1] != 0], minlength=len(total))
        total += np.bincount(x[2:][x[1:-1] == 0], minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["at", "n"])


class Letters:
    """Trigram counts, and the log likelihood of a word as one of the corpus's spellings."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape((_SIZE,) * 3).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        single = (one + 1) / (one.sum() + _SIZE)
        pair = (two + BACK_OFF * single) / (two.sum(axis=1, keepdims=True) + BACK_OFF)
        self._log = np.log((three + BACK_OFF * pair[None]) / (three.sum(axis=2, keepdims=True) + BACK_OFF)).astype(np.float32)

    @staticmethod
    def of(words: DataFrame) -> Letters:
        """Model of the words in column ``word``; at most one row per trigram of the alphabet reaches the driver."""
        table = words.select("word").mapInArrow(_trigrams, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(_SIZE**3, np.int64)
        counts[np.asarray(table.column("at"))] = np.asarray(table.column("n"))
        return Letters(counts)

    def likelihood(self, word: str) -> float:
        a, b, total = 0, 0, 0.0
        for c in [*codes(word), 0]:
            total += self._log[a, b, c]
            a, b = b, c
        return float(total)

    def best(self, options: list[list[tuple[str, float]]]) -> tuple[str, float]:
        """Likeliest word that takes one of the (letter, log weight) of every place, and its weight."""
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for place in [*options, [("", 0.0)]]:
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, word) in states.items():
                for letter, weight in place:
                    c = codes(letter)[0] if letter else 0
                    s = score + weight + float(self._log[a, b, c])
                    if (b, c) not in new or new[b, c][0] < s:
                        new[b, c] = (s, word + letter)
            states = new
        score, word = max(states.values())
        return word, score


def spread(characters: int) -> float:
    """Log likelihood of a code: letters and digits as they come."""
    return characters * -math.log(36)
