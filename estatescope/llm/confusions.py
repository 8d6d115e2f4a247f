"""Which letters a scanner takes for which: learnt by aligning rare words with frequent ones.

A rare word that differs from a far more frequent one in a single place, by one or two
letters on either side, is one vote for that confusion. A confusion counts if it explains
a fair share of the frequent words it could have touched. The confusions also give
every word a key that all its misreadings share, however many places they were misread in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope.llm.bitmap import Bitmap

#: Look-alikes known before any text is seen, what is read (left) for what was printed (right).
KNOWN = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("9", "g"), ("@", "a"), ("l", "i"), ("ri", "n"),
    ("rn", "m"), ("c", "e"), ("f", "t"), ("cl", "d"), ("li", "h"), ("ii", "u"), ("d", "cl"), ("vv", "w"),
)
#: Letters of the shortest words aligned, share of the words it could touch that a new confusion must explain, and
#: how many different ones.
ALIGNED, SHARE, WORDS = 6, 0.05, 3
#: Places of a word that one or two letters can be left out at, usually.
PLACES = 16
#: Chance that a word of a scan is misread in a given way, shared out over the confusions.
MISREAD = 0.3


def log(p: float) -> float:
    """Logarithm bounded below."""
    return math.log(max(p, 1e-15))


@dataclass
class Confusions:
    """Confusions with the log chance of each among all, and the rate at which its letters are misread so; ``images``
    is what the letters become in the key of a word."""

    chance: dict[tuple[str, str], float]
    rate: dict[tuple[str, str], float]
    images: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(votes: dict[tuple[str, str], float], touched: dict[tuple[str, str], float] | None = None) -> Confusions:
        """From how many words each confusion explains, of how many it could have touched; the known ones take part
        with one word at least."""
        touched = touched or {}
        usual = (sum(votes.values()) + 1) / (sum(touched.values()) + 1)
        votes = {pair: votes.get(pair, 0) + (pair in KNOWN) for pair in {*KNOWN, *votes}}
        ranked = sorted(votes, key=lambda p: (p not in KNOWN, -votes[p], p))
        root: dict[str, str] = {}
        parts: dict[str, tuple[str, ...]] = {}

        def find(c: str) -> str:
            while root.get(c, c) != c:
                c = root[c]
            return c

        def image(c: str) -> str:
            c = find(c)
            return "".join(map(image, parts[c])) if c in parts else c

        def within(c: str, of: str) -> bool:
            of = find(of)
            return find(c) == of or of in parts and any(within(c, x) for x in parts[of])

        used = []
        for a, b in ranked:
            if len(a) == len(b) == 1:
                x, y = find(a), find(b)
                clash = x != y and (x in parts and y in parts or within(x, y) or within(y, x))
                if not clash and x != y:
                    x, y = (y, x) if x in parts else (x, y)
                    root[x] = y
            else:
                one, two = (a, b) if len(a) == 1 else (b, a)
                x = find(one)
                clash = "".join(map(image, two)) != image(x) if x in parts else any(within(x, c) for c in two)
                if not clash:
                    parts[x] = tuple(two)
            # one that contradicts those before it would give no common key
            if not clash:
                used.append((a, b))
        total = sum(votes[p] for p in used)
        letters = {c for a, b in used for c in a + b}
        rate = {p: min(1.0, votes[p] / touched[p]) if touched.get(p) else min(1.0, usual) for p in used}
        return Confusions({p: log(MISREAD * votes[p] / total) for p in used}, rate, {c: image(c) for c in sorted(letters)})

    def key(self, word: str) -> str:
        """What ``word`` shares with all it may be a misreading of."""
        return word.translate(self._table)

    def __post_init__(self) -> None:
        self._table = str.maketrans(self.images)
        self._from: dict[str, list[tuple[str, float]]] = {}
        for (a, b), p in self.chance.items():
            self._from.setdefault(a, []).append((b, p))

    def channel(self, seen: str, printed: str) -> tuple[float, list[tuple[str, str]]] | None:
        """(log probability, confusions) of the likeliest way to read ``printed`` as ``seen``, or None."""
        best: dict[tuple[int, int], tuple[float, list]] = {(0, 0): (0.0, [])}
        for i in range(len(seen) + 1):
            for (x, j), (p, how) in [(k, v) for k, v in best.items() if k[0] == i]:
                steps = []
                if i < len(seen) and j < len(printed) and seen[i] == printed[j]:
                    steps.append((i + 1, j + 1, p, how))
                for n in (1, 2):
                    for b, q in self._from.get(seen[i : i + n], ()) if i + n <= len(seen) else ():
                        if printed.startswith(b, j):
                            steps.append((i + n, j + len(b), p + q, [*how, (seen[i : i + n], b)]))
                for u, v, score, path in steps:
                    if (u, v) not in best or best[u, v][0] < score:
                        best[u, v] = (score, path)
        return best.get((len(seen), len(printed)))

    def letters(self, c: str) -> list[tuple[str, float]]:
        """Letters a single character may stand for."""
        return [(b, p) for b, p in self._from.get(c, ()) if len(b) == 1 and b.isalpha()]


def _windows(word: str) -> Iterator[tuple[int, str]]:
    for k in (1, 2):
        for i in range(len(word) - k + 1):
            part = word[i : i + k]
            if part.isascii():
                yield xxhash.xxh64_intdigest(f"{word[:i]}\0{word[i + k :]}"), part


def _open(bitmap: Bitmap | None):
    """Arrow map: every word with one or two letters left out, as far as ``bitmap`` may hold the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, rows = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                for key, part in _windows(word):
                    keys.append(key)
                    parts.append(part)
                    rows.append(row)
            h = np.array(keys, np.uint64)
            keep = np.ones(len(h), bool) if bitmap is None else bitmap.contains(h)
            take = pa.array(np.array(rows, np.int64)[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep].view(np.int64)), pa.array(parts, pa.string()).filter(pa.array(keep)), *(batch.column(c).take(take) for c in ("word", "n", "d"))],
                ["h", "part", "word", "n", "d"],
            )

    return run


def learn(vocabulary: DataFrame, printed: DataFrame, ratio: int, frequent_words: int) -> Confusions:
    """Confusions of a corpus.

    vocabulary: (word, n, low, d), n occurrences and d texts of every word; printed: the
    words among them that may have been printed; ratio: how much more frequent a word must be than its misreading;
    frequent_words: about how many words occur so many times at all.
    """
    columns = "h long, part string, word string, n long, d long"
    # a word with fewer occurrences is ``ratio`` times as frequent as nothing
    frequent = printed.where((F.char_length("word") >= ALIGNED) & (F.col("n") >= ratio)).select("word", "n", "d")
    ends = frequent.mapInArrow(_open(None), columns)
    bitmap = Bitmap.gather(ends.select("h"), size=PLACES * frequent_words)
    rare = vocabulary.where(F.char_length("word") >= ALIGNED).select("word", "n", "d").mapInArrow(_open(bitmap), columns)
    both = rare.toDF("h", "a", "seen", "n_a", "d_a").join(ends.toDF("h", "b", "printed", "n_b", "d_b"), "h")
    often = (F.col("d_b") >= ratio * F.col("d_a")) | (F.col("n_b") >= ratio * F.col("n_a"))
    apart = (F.substring("a", 1, 1) != F.substring("b", 1, 1)) & (F.expr("right(a, 1)") != F.expr("right(b, 1)"))
    one = F.char_length("a") + F.char_length("b") <= 3
    votes = both.where(often & apart & one).groupBy("a", "b").agg(F.sum("d_a").alias("n"), F.count_distinct("printed").alias("words"))
    # at most as many rows as there are pairs of one or two ASCII characters; few are left
    touched = ends.groupBy(F.col("part").alias("b")).agg(F.count_distinct("word").alias("all"), F.sum("d").alias("times"))
    known = F.concat_ws(">", "a", "b").isin([f"{a}>{b}" for a, b in KNOWN])
    fair = (F.col("words") >= WORDS) & (F.col("words") >= SHARE * F.col("all")) & F.col("b").rlike("^[a-z]+$")
    rows = votes.join(touched, "b").where(known | fair).select("a", "b", "n", "times").collect()
    return Confusions.of({(r["a"], r["b"]): r["n"] for r in rows}, {(r["a"], r["b"]): r["times"] for r in rows})
