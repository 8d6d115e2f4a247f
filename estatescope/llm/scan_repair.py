"""Noise in text from scanned pages: finding it and giving continuous paragraphs back.

A noisy channel. The corpus gives the words, how often they stand next to each other and
how words are spelt; character confusions learnt from it give the probability that a
printed word was read as another. Words that may be misreadings are collected in a table: those of
a far more frequent word share its key, however many letters were misread, and words with digits among
their letters that no word explains are weighed by their spelling. The lines that hold one are
decoded by Viterbi over the candidate words, every place for itself. Cut words, page
numbers and running headers are told by the layout of the lines.

All counts are of distinct texts, so copies and repetition within a text are no evidence.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm import confusions, letters, scan_text
from estatescope.llm.bitmap import Bitmap, word_hash
from estatescope.llm.confusions import Confusions, log
from estatescope.llm.dart import mix64
from estatescope.llm.letters import Letters

#: How much more frequent, by distinct texts or by occurrences, a printed word must be than its misreading.
RATIO = 30
#: Share of the occurrences of a vocabulary word that begin with a small letter, at least.
SMALL_SHARE = 0.1
#: Probability, at least and at most, that a word with a much more frequent look-alike is a word of its own; it rises
#: with the texts beyond so many times the misreadings expected, and so many more.
OWN_WORD, MOST_OWN, SLACK = 0.005, 0.95, (8.0, 4.0)
#: Share of codes among the words with digits, and how much less likely a misreading becomes with every further
#: text that holds it while the printed word doesn't appear (copies weigh by their logarithm).
CODES, AGAIN = 0.003, 20.0

#: Letters from which on a word at the very end of a text is taken for a whole one.
WHOLE = 6

_WORD = r"\p{L}[\p{L}\p{N}@]*|[\p{Nd}@][\p{L}\p{N}@]*\p{L}[\p{L}\p{N}@]*"
#: Lines that may be traces; decided line by line afterwards.
_LAYOUT = (
    r"(?i)\p{L}[ \t]?[-¬­‐][ \t]*\r?\n|(?m)^\s*(?:p\. ?\d{1,4}|[—–-] ?\d{1,4} ?[—–-]|(?:página|page|pág\.|pag\.)\s*\d.*"
    r"|\d{1,4}(?:\s?/\s?\d{1,4})?|\[\d{1,4}\]|[ivxlc]{2,7}"
    r"|([^\x00-\x7F]{1,6}) ?\d{1,4} ?\1|p[^\x00-\x7F]{1,6}gina\s*\d{1,4}(?:\s*(?:de|/)\s*\d{1,4})?)\s*$"
)
#: Lines that may be running headers without a page number: within a sentence, or after a form feed.
_HEADER = r"[\p{Ll},][ \t\r]*\n(?:[^\n\p{Ll}]{5,62}|[^\n]{0,60} · [^\n]{0,60})\n\s*\p{Ll}|\n\f"

#: A word cut at a line end (for the engine's expressions), such an end, and the word that leads a line.
_CUT = r"(\p{L})[ \t]?[-¬­‐][ \t]*\r?\n[ \t]*(?=\p{Ll})"
_CUT_END = re.compile(r"[^\W\d_][ \t]?[-¬­‐][ \t]*$")
_LEADING = re.compile(r"[ \t]*([a-zß-öø-ÿ](?:[^\W_]|@)*)")

_FOUND = "seen string, printed string, d_seen long, d_printed long, weight double, expected double"
_ENTRY = "struct<seen:string,printed:string,d_seen:bigint,d_printed:bigint,weight:double,expected:double>"


def _words(text: Column) -> Column:
    """Words of a text, those cut at a line end joined."""
    joined = F.when(F.contains(text, F.lit("\n")), F.regexp_replace(text, _CUT, "$1")).otherwise(text)
    return F.regexp_extract_all(joined, F.lit(_WORD), F.lit(0))


def _common() -> Column:
    """Whether a word of the vocabulary is no name."""
    return F.col("low") >= SMALL_SHARE * F.col("n")


def _hashes(words: list[str]) -> np.ndarray:
    return np.array([word_hash(w) for w in words], np.uint64)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * np.uint64(3) + right)


def _single(word: np.ndarray) -> np.ndarray:
    return mix64(word * np.uint64(5) + np.uint64(1))


def _signed(h: np.uint64) -> int:
    return int(np.uint64(h).view(np.int64))


def _small(word: str) -> bool:
    """Whether a word is set in small letters, but for a first capital."""
    return sum(c.islower() for c in word) > sum(c.isupper() for c in word)


def _strange(c: str, beyond: str) -> bool:
    """Whether a character beside a word, with what stands beyond it, tells that the word is a piece: no space, quote,
    hyphen or list mark, or such a one within a word."""
    if c.isascii():
        return False
    if c in "\xa0¿¡":
        return beyond.isalpha()
    return not c.isspace() and unicodedata.category(c) not in ("Pi", "Pf", "Cf") and c not in "•…€£¬‐‑"


def _coded(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a column of lists, their number at every place, and the row of every place."""
    coded = column.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(column)), np.asarray(pc.list_value_length(column)))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of distinct texts in small letters: occurrences in all copies, those that begin small, how many texts hold
    them, and how many set in small letters."""
    for batch in batches:
        seen, index, row = _coded(batch.column("words"))
        copies = np.asarray(batch.column("copies"))[row]
        small: dict[str, int] = {}
        of = np.array([small.setdefault(w.lower(), len(small)) for w in seen], np.int64)
        begins, set_small = (np.array([f(w) for w in seen], bool) for f in (lambda w: w[0].islower(), _small))
        word, size = of[index], max(len(small), 1)
        n = np.bincount(word, copies, size)
        low = np.bincount(word, copies * begins[index], size)
        d = np.bincount(np.unique(row * size + word) % size, minlength=size)
        d_small = np.bincount(np.unique((row * size + word)[set_small[index]]) % size, minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(small), pa.string()), *(pa.array(x[: len(small)].astype(np.int64)) for x in (n, low, d, d_small))],
            ["word", "n", "low", "d", "d_small"],
        )


def _keys(channel: Confusions):
    """Arrow map: every word with the key it shares with its misreadings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pa.array([channel.key(w) for w in batch.column("word").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([key, *batch.columns], ["key", *batch.schema.names])

    return run


def _align(channel: Confusions):
    """Arrow map: (seen, printed) where confusions lead from one to the other, with the log of how often they should
    and the number of texts expected to show it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [channel.channel(a, b) for a, b in zip(batch.column("seen").to_pylist(), batch.column("printed").to_pylist())]
            keep = np.array([f is not None for f in found], bool)
            rows = batch.filter(pa.array(keep))
            found = [f for f in found if f is not None]
            d = rows.column("d_printed").to_pylist()
            weight = [math.log(n) + p for n, (p, _) in zip(d, found)]
            expected = [n * min(channel.rate[pair] for pair in how) for n, (_, how) in zip(d, found)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(weight, pa.float64()), pa.array(expected, pa.float64())], [*rows.schema.names, "weight", "expected"])

    return run


def _spelt(channel: Confusions, model: Letters):
    """Arrow map: words with digits among small letters that are likelier misread names than codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n, d in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "d"))):
                options = [[(c, 0.0)] if c.isalpha() else channel.letters(c) for c in word]
                if not all(options):
                    continue
                printed, score = model.best(options)
                own = log(CODES) + letters.spread(len(word)) + (d - 1) * math.log(AGAIN) + math.log(n)
                if score > own:
                    rows.append((word, printed, d, 0, score - own, 0.0))
            columns = list(zip(*rows)) or [[]] * 6
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            names = ["seen", "printed", "d_seen", "d_printed", "weight", "expected"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return run


def _maybe(bitmap: Bitmap):
    """Arrow map: the texts that may hold a trace, with their words that may be in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, index, row = _coded(batch.column("words"))
            small = [w.lower() for w in seen]
            hit = np.array([_small(w) or w.isalpha() for w in seen], bool)
            if seen:
                hit &= bitmap.contains(_hashes(small))
            at = np.flatnonzero(hit[index])
            held: dict[int, set[str]] = {}
            for r, k in zip(row[at], index[at]):
                held.setdefault(int(r), set()).add(small[k])
            keep = np.asarray(batch.column("layout").fill_null(False)).astype(bool)
            keep[list(held)] = True
            suspects = pa.array([sorted(held.get(int(r), ())) for r in np.flatnonzero(keep)], pa.list_(pa.string()))
            rows = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([rows.column("h"), rows.column("text"), rows.column("layout"), suspects], ["h", "text", "layout", "suspects"])

    return run


def _options(entries: list[dict] | None) -> dict[str, list[tuple[str, float]]]:
    """Misread word to (printed word, log probability): the word itself first, unless only its spelling speaks."""
    by: dict[str, list[dict]] = {}
    for e in entries or []:
        by.setdefault(e["seen"], []).append(e)
    table: dict[str, list[tuple[str, float]]] = {}
    for seen, given in by.items():
        known = sorted((e for e in given if e["d_printed"]), key=lambda e: (-e["weight"], e["printed"]))
        if not known:
            table[seen] = [(given[0]["printed"], 0.0)]
            continue
        # what its look-alikes' misreadings cannot account for is the word's own
        d, expected = known[0]["d_seen"], sum(e["expected"] for e in known)
        own = min(MOST_OWN, OWN_WORD + max(0.0, d - SLACK[0] * expected - SLACK[1]) / d)
        weights = np.exp(np.array([e["weight"] - known[0]["weight"] for e in known]))
        table[seen] = [(seen, log(own)), *((e["printed"], log((1 - own) * w)) for e, w in zip(known, weights / weights.sum()))]
    return table


def _places(text: str) -> Iterator[tuple[int, list[str], list[str], str]]:
    """(number, words, words in small letters, rest) of every line. A word cut at the end of a line is joined with its rest,
    which leads the next line. What isn't weighed stands as it is after a blank: codes in capitals, such a rest, pieces
    beside a sign no text has within words, and a short word at the very end, which may be cut off."""
    lines = text.replace("\r\n", "\n").split("\n")
    rest = ""
    for i, line in enumerate(lines):
        found = list(scan_text.WORD.finditer(line))
        raw = [m.group() for m in found]
        words = [w.lower() if not scan_text.odd(w) or _small(w) else " " + w for w in raw]
        if not line.isascii():
            around = " " + line + "  "
            broken = [_strange(around[m.start()], around[max(0, m.start() - 1)]) or _strange(around[m.end() + 1], around[m.end() + 2]) for m in found]
            words = [" " + w if b else x for w, x, b in zip(raw, words, broken)]
        if rest and raw:
            words[0] = " " + raw[0]
        rest = ""
        if raw and i + 1 < len(lines) and not words[-1].startswith(" ") and _CUT_END.search(line):
            after = _LEADING.match(lines[i + 1])
            if after and line.rstrip("-¬\u00ad‐ \t").endswith(raw[-1]):
                rest = after.group(1)
                words[-1] = (raw[-1] + rest).lower()
        if raw and raw[-1].isalpha() and len(raw[-1]) < WHOLE and i + 1 == len(lines) and line.endswith(raw[-1]):
            words[-1] = " " + raw[-1]
        yield i, raw, words, rest


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, pair) of every pair of neighbouring candidate words, and of the words themselves."""
    for batch in batches:
        keys, left, right = [], [], []
        for key, text, entries in zip(*(batch.column(c).to_pylist() for c in ("h", "text", "entries"))):
            table = _options(entries)
            pairs = set()
            for _, _, words, _ in _places(text):
                if not any(w in table for w in words):
                    continue
                for a, b in zip(words, words[1:]):
                    if a in table or b in table:
                        pairs |= {(x, y) for x, _ in table.get(a, [(a, 0)]) for y, _ in table.get(b, [(b, 0)])}
            keys += [key] * len(pairs)
            left += [a for a, _ in pairs]
            right += [b for _, b in pairs]
        a, b = _hashes(left), _hashes(right)
        h = np.concatenate([_pair(a, b), _single(a), _single(b)]) if keys else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(keys * 3, pa.binary()), pa.array(h.view(np.int64))], ["h", "pair"])


def _count_pairs(bitmap: Bitmap):
    """Arrow map: (pair, n) of the neighbouring words, and words, that are needed, and how many texts hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, index, row = _coded(batch.column("words"))
            if not seen:
                continue
            word = _hashes([w.lower() for w in seen])[index]
            inside = row[:-1] == row[1:]
            h = np.concatenate([_pair(word[:-1], word[1:])[inside], _single(word)])
            row = np.concatenate([row[:-1][inside], row])
            wanted = bitmap.contains(h)
            h, row = h[wanted], row[wanted]
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, n = np.unique(h[once], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["pair", "n"])

    return run


class Context:
    """How much likelier two words are beside each other than anywhere, as the other texts have it.

    table: words that may be misread, which as they stand have no neighbours of their own: versions of one text would
    lend them those; counts: texts that hold a pair or a word; total: words of all texts, one text a word
    """

    def __init__(self, table: dict, counts: dict[int, int], total: float):
        self.table, self.counts, self.total = table, counts, max(total, 1.0)
        self.here: set[int] = set()

    def place(self, words: list[str]) -> None:
        """Take the words of a line as given by this text, which is no evidence for itself."""
        h = _hashes(words)
        self.here = {*map(_signed, _single(h)), *map(_signed, _pair(h[:-1], h[1:]))}

    def _n(self, h: np.ndarray) -> int:
        at = _signed(h[0])
        return max(0, self.counts.get(at, 0) - (at in self.here))

    def gain(self, left: str, right: str) -> float:
        """Log of the likelihood of ``right`` after ``left`` against that of ``right``, bounded below by a half."""
        if left in self.table or right in self.table:
            return 0.0
        a, b = _hashes([left]), _hashes([right])
        both, first, second = self._n(_pair(a, b)), self._n(_single(a)), self._n(_single(b))
        return math.log(0.5 + 0.5 * (both * self.total / (first * second) if both and first and second else 0.0))


def _decode(total: float):
    """Arrow map: one row per text with traces: what was found, the words put right, the repaired text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, entries, pairs in zip(*(batch.column(c).to_pylist() for c in ("h", "text", "entries", "pairs"))):
                table = _options(entries)
                context = Context(table, {p["pair"]: p["n"] for p in pairs or []}, total)
                fixes = _fixes(text, table, context) if table else {}
                lines = text.replace("\r\n", "\n").split("\n")
                pages = scan_text.page_lines(lines)
                cuts = scan_text.cut_words(text)
                headers = scan_text.header_lines(lines, pages)
                if fixes or pages or cuts or headers:
                    words = sorted({(raw, now) for raw, now in fixes.values()})
                    repaired = scan_text.repair(text, {at: now for at, (_, now) in fixes.items()})
                    rows.append((key, cuts, len(pages), len(headers), [{"seen": a, "printed": b} for a, b in words], repaired))
            cols = list(zip(*rows)) or [[]] * 6
            words = pa.list_(pa.struct([("seen", pa.string()), ("printed", pa.string())]))
            types = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), words, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, types)], ["h", "cut_words", "page_numbers", "headers", "misread", "text"]
            )

    return run


def _fixes(text: str, table: dict, context: Context) -> dict[tuple[int, int], tuple[str, str]]:
    """(line, number of the word in it) to the word as seen and as printed, where decoding the line prefers another one."""
    out: dict[tuple[int, int], tuple[str, str]] = {}
    for i, raw, words, rest in _places(text):
        if not any(w in table for w in words):
            continue
        context.place(words)
        for k, (was, now) in enumerate(zip(words, scan_text.viterbi(words, table, context.gain))):
            if was == now:
                continue
            if rest and k + 1 == len(words):
                # a cut word stays cut at about the same place
                now, at = scan_text.with_case(now, raw[k] + rest), min(len(raw[k]), len(now) - 1)
                parts = [((i, k), raw[k], now[:at]), ((i + 1, 0), rest, now[at:])] if at else []
                out |= {place: (seen, printed) for place, seen, printed in parts if seen != printed}
            else:
                out[i, k] = (raw[k], scan_text.with_case(now, raw[k]))
    return out


class ScanRepair:
    """Scanning traces of the texts of ``df``.

    key, text: the columns read; others are ignored. Null and empty texts have no traces; a
    row given twice is reported once. Whether a file is marked as scanned plays no part.
    """

    def __init__(self, df: DataFrame, key: str = "id", text: str = "text_excerpt"):
        texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text <> ''")
        self._members = texts.select("id", F.unhex(F.md5("text")).alias("h"))
        once = texts.groupBy("text").agg(F.count("*").alias("copies"))
        # no trace of the layout without lines
        layout = F.contains("text", F.lit("\n")) & (F.col("text").rlike(_LAYOUT) | F.col("text").rlike(_HEADER))
        distinct = workspace.materialize(once.select(F.unhex(F.md5("text")).alias("h"), "text", "copies", _words(F.col("text")).alias("words"), layout.alias("layout")), "distinct")
        sums = [F.sum(c).alias(c) for c in ("n", "low", "d", "d_small")]
        counts = distinct.select("words", "copies").mapInArrow(_count, "word string, n long, low long, d long, d_small long")
        vocabulary = workspace.materialize(counts.groupBy("word").agg(*sums), "vocabulary")
        totals = vocabulary.agg(F.sum("d"), F.count("*"), F.count_if(F.col("n") >= RATIO)).first()
        total, size = float(totals[0] or 1), int(totals[1])
        model = Letters.of(vocabulary.where(F.col("word").rlike(r"^\p{L}+$")))
        channel = confusions.learn(vocabulary, vocabulary.where(_common() & F.col("word").rlike(r"^\p{L}+$")), RATIO, int(totals[2]))
        table = workspace.materialize(self._table(vocabulary, channel, model), "table")
        bitmap = Bitmap.gather(table.select("seen").mapInArrow(_hash_words, "h long"), size=size)
        maybe = workspace.materialize(distinct.select("h", "text", "layout", "words").mapInArrow(_maybe(bitmap), "h binary, text string, layout boolean, suspects array<string>"), "maybe")
        held = maybe.select("h", F.explode("suspects").alias("seen")).join(table, "seen").groupBy("h").agg(F.flatten(F.collect_list("entries")).alias("entries"))
        marked = maybe.join(held, "h", "left").where("layout or entries is not null").select("h", "text", "entries")
        marked = workspace.materialize(marked, "marked")
        needed = workspace.materialize(marked.where("entries is not null").mapInArrow(_needed, "h binary, pair long").distinct(), "needed")
        wanted = Bitmap.gather(needed.select(F.col("pair").alias("h")), size=needed.count())
        counted = distinct.select("words").mapInArrow(_count_pairs(wanted), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        pairs = needed.join(counted, "pair").groupBy("h").agg(F.collect_list(F.struct("pair", "n")).alias("pairs"))
        self._decoded = marked.join(pairs, "h", "left").mapInArrow(
            _decode(total),
            "h binary, cut_words int, page_numbers int, headers int, misread array<struct<seen:string,printed:string>>, text string",
        )

    @staticmethod
    def _table(vocabulary: DataFrame, channel: Confusions, model: Letters) -> DataFrame:
        """(seen, entries): what every word may be a misreading of."""
        keyed = "key string, word string, n long, d long"
        seen = vocabulary.select("word", "n", "d").mapInArrow(_keys(channel), keyed).toDF("key", "seen", "n_seen", "d_seen")
        common = _common().alias("common")
        whole = vocabulary.where(F.col("word").rlike(r"^\p{L}+$")).select("word", "n", "d", common).mapInArrow(_keys(channel), keyed + ", common boolean")
        whole = whole.toDF("key", "printed", "n_printed", "d_printed", "common")
        # by texts or by occurrences: a misreading has few texts whatever their copies, a printed word may stand in few
        often = (F.col("d_printed") >= RATIO * F.col("d_seen")) | (F.col("n_printed") >= RATIO * F.col("n_seen"))
        # a name may only be what a word with digits was; such a word is hardly one of its own
        odd = ~F.col("seen").rlike(r"^\p{L}+$")
        fits = (often & (odd | F.col("common"))) | (odd & (F.col("d_printed") >= F.col("d_seen")))
        pairs = seen.join(whole, "key").where(fits & (F.col("seen") != F.col("printed"))).select("seen", "printed", "d_seen", "d_printed")
        explained = pairs.mapInArrow(_align(channel), _FOUND)
        codes = vocabulary.where(~F.col("word").rlike(r"^\p{L}+$") & (F.col("d_small") > 0)).select("word", "n", "d")
        every = explained.unionByName(codes.mapInArrow(_spelt(channel, model), _FOUND))
        return every.select("seen", F.struct(*every.columns).cast(_ENTRY).alias("e")).groupBy("seen").agg(F.collect_list("e").alias("entries"))

    def _of_files(self, decoded: DataFrame) -> DataFrame:
        return self._members.join(decoded, "h").dropDuplicates(["id"]).drop("h")

    def found(self) -> DataFrame:
        """(id) of every text with at least one trace."""
        return self._of_files(self._decoded.select("h")).select("id")

    def repaired(self) -> DataFrame:
        """(id, cut_words, page_numbers, headers, misread, text): the traces of every such text and its repaired paragraphs."""
        return self._of_files(self._decoded)


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("seen").to_pylist()).view(np.int64))], ["h"])
