"""Text decoded with the wrong character encoding: finding it and restoring it.

Every distinct word of the corpus that is not plain ASCII is written down in all
the garbled forms that chains of encodings give it. The corpus's words are hash-joined
with that table: a word that equals the garbled form of a more frequent word (or a
form only wrong decoding produces) is garbled, and the word it came from replaces
it; an original that is itself garbled is followed to its own original. Single symbols are ambiguous (a Greek letter may be meant), so they count only
where the corpus shows them together with longer garbled words.

A reader of single bytes garbles every character by itself. So a chain is a table of characters, and a chain that
gives some character of a word two neighbours the corpus doesn't have together is left out for that word.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm.bitmap import Bitmap, word_hash

#: Encodings a text was written in, and those it may have been read with.
WRITTEN = ("utf-8", "cp1252", "cp437", "cp850", "mac_roman", "cp1251", "koi8-r", "iso8859-15", "shift_jis")
READ = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "cp1250", "cp1253", "koi8-r")
#: Those met most often.
USUAL = ({"utf-8", "cp1252", "cp437", "cp850", "mac_roman"}, set(READ) - {"koi8-r"})
#: Readers that take several bytes at a time.
READ_WIDE = ("utf-8", "gbk")
#: How many times UTF-8 may be misread one after the other, and how many times anything else.
DEPTH, DEPTH_OTHER = 3, 2
#: Pairs of neighbouring characters a bitmap is laid out for.
PAIRS = 1 << 18
#: Words of one task while forms are made, and most tasks.
TASK_WORDS, MOST_TASKS = 1000, 4096
#: Share of a symbol's values that must hold longer garbled words for the symbol to count by itself.
SYMBOL_SHARE = 0.5

#: A word: letters around at least one character beyond ASCII, with the first digit of a number that follows at
#: once (a currency sign is told from a letter by it).
_WORD = r"[A-Za-z]*[^\x00-\x7F](?:[A-Za-z]|[^\x00-\x7F])*(?:[0-9](?![A-Za-z@]))?"
_RUN = re.compile(r"[^\x00-\x7f]+")
_LOST = "�"
#: Characters that pairs of ASCII bytes make when read as 16-bit code units.
_PAIRED = re.compile("[਀-૿ഀ-෿ -ⁿ℀-绿]{3,}")


def encode(text: str, codec: str) -> bytes | None:
    """Bytes of ``text``, or None; cp1252 keeps its five unassigned bytes as control characters."""
    try:
        return text.encode(codec)
    except UnicodeEncodeError:
        if codec != "cp1252":
            return None
    try:
        return b"".join(c.encode("latin-1") if c in "\x81\x8d\x8f\x90\x9d" else c.encode("cp1252") for c in text)
    except UnicodeEncodeError:
        return None


def decode(raw: bytes, codec: str) -> str | None:
    """Text of ``raw`` as a lenient reader shows it, or None where the codec has no such byte."""
    if codec == "utf-8":
        return raw.decode("utf-8", "replace")
    try:
        return raw.decode(codec)
    except UnicodeDecodeError:
        if codec != "cp1252":
            return None
    return "".join(bytes([b]).decode("latin-1" if b in b"\x81\x8d\x8f\x90\x9d" else "cp1252") for b in raw)


_NONE = "\uffff"


@lru_cache(maxsize=1 << 18)
def _step(text: str, written: str, read: str) -> str:
    raw = encode(text, written)
    out = None if raw is None else decode(raw, read)
    return _NONE if out is None else out


class Chain(dict):
    """Characters garbled by a chain of (written, read) steps; what cannot pass it becomes U+FFFF."""

    def __init__(self, steps: tuple[tuple[str, str], ...]):
        self.steps, self.name = steps, ">".join(x for step in steps for x in step)
        self.wide = steps[0][0] == "utf-8"
        #: chains of few steps and usual encodings are tried first
        self.rank = -len(steps) - sum(x not in usual for x, usual in zip(steps[0], USUAL))

    def __missing__(self, code: int) -> str:
        text = chr(code)
        for written, read in self.steps:
            text = _step(text, written, read)
            if text == _NONE:
                break
        self[code] = text
        return text


@lru_cache(maxsize=8)
def chains(written: tuple[str, ...] = WRITTEN, read: tuple[str, ...] = READ) -> list[Chain]:
    """All chains of single-byte readers: UTF-8 misread up to DEPTH times, any other encoding once and then UTF-8."""
    out = [Chain(tuple(("utf-8", r) for r in rs)) for n in range(1, DEPTH + 1) for rs in itertools.product(read, repeat=n)]
    firsts = [(w, r) for w in written if w != "utf-8" for r in read if r != w]
    return out + [Chain(((w, r), *(("utf-8", x) for x in rs))) for w, r in firsts for n in range(DEPTH_OTHER) for rs in itertools.product(read, repeat=n)]


def is_clean(word: str) -> bool:
    """Whether no reader's bytes of ``word`` are UTF-8, so that it isn't a misreading of UTF-8 by itself."""
    for codec in READ:
        raw = encode(word, codec)
        if raw is None or raw.isascii():
            continue
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        # by chance the bytes may be those of a script no word of this kind is written in
        if all(c < "\u0530" or "\u2000" <= c < "\u2300" for c in text):
            return False
    return True


def garbled_forms(word: str, possible=None) -> dict[str, Chain | None]:
    """Form to chain (None for readers of several bytes), of every chain that changes ``word``.

    possible: which chains are worth the trouble, from (character, chains); all without it. Words that look garbled
    themselves are garbled once more only.
    """
    out: dict[str, Chain | None] = {}
    deep = is_clean(word)
    for text in {word, unicodedata.normalize("NFC", word), unicodedata.normalize("NFD", word)}:
        able = chains() if possible is None else possible(text)
        for chain in able:
            if not deep and len(chain.steps) > 1:
                continue
            form = text.translate(chain)
            if _NONE not in form and form != text:
                out.setdefault(form, chain)
        for written in WRITTEN:
            raw = encode(text, written)
            for read in READ_WIDE:
                form = decode(raw, read) if raw is not None and read != written else None
                # bytes that are good UTF-8 were written so: reading them as UTF-8 repairs, only losses garble
                if form is not None and form != text and (read != "utf-8" or _LOST in form):
                    out.setdefault(form, None)
    out.pop(word, None)
    return out


def paired_bytes(run: str) -> str | None:
    """The ASCII text whose bytes, two by two, were read as the characters of ``run``, or None."""
    raw = run.encode("utf-16-le", "surrogatepass")
    if not all(32 <= b < 127 or b in (9, 10, 13) for b in raw):
        return None
    text = raw.decode("ascii")
    letters = sum(c.isalnum() or c == " " for c in text)
    return text if letters >= 0.6 * len(text) else None


def _pairs(word: str) -> list[str]:
    """Neighbours beyond ASCII, and the single characters beyond ASCII."""
    beyond = [not c.isascii() for c in word]
    return [word[i : i + 2] for i in range(len(word) - 1) if beyond[i] and beyond[i + 1]] + [c for c, b in zip(word, beyond) if b]


def _pair_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {p for word in batch.column("token").to_pylist() for p in _pairs(word)}
        yield pa.RecordBatch.from_arrays([pa.array(np.array([word_hash(p) for p in found], np.uint64).view(np.int64))], ["h"])


def _token_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([word_hash(w) for w in batch.column("token").to_pylist()], np.uint64).view(np.int64))], ["h"])


def _forms(pairs: Bitmap, tokens: Bitmap):
    """Arrow map: the garbled forms of every word that the corpus may hold; those of UTF-8 only of runs."""
    able: dict[str, frozenset[int]] = {}
    known: dict[str, bool] = {}

    def met(piece: str) -> bool:
        if piece not in known:
            known[piece] = bool(pairs.contains(np.array([word_hash(piece)], np.uint64))[0])
        return known[piece]

    def possible(text: str) -> list[Chain]:
        every, left = chains(), None
        for c in {c for c in text if not c.isascii()}:
            if c not in able:
                forms = [chain[ord(c)] for chain in every]
                # its characters first: most forms have one that is nowhere
                able[c] = frozenset(
                    k for k, f in enumerate(forms)
                    if f != _NONE and all(x.isascii() or met(x) for x in f) and all(map(met, _pairs(f)))
                )
            left = able[c] if left is None else left & able[c]
        return [every[k] for k in sorted(left or ())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n, d, run_only in zip(*(batch.column(c).to_pylist() for c in ("token", "n", "d", "run"))):
                if _LOST in word:
                    continue
                made = garbled_forms(word, possible)
                if run_only:
                    made = {f: c for f, c in made.items() if c is not None and c.wide}
                if not made:
                    continue
                there = tokens.contains(np.array([word_hash(f) for f in made], np.uint64))
                for (form, chain), ok in zip(made.items(), there):
                    if ok:
                        # more characters than the word: several bytes of one character were read one by one
                        rows.append((form, word, run_only, n, d, chain is not None and chain.wide and len(form) > len(word), -1 if chain is None else chain.rank))
            cols = list(zip(*rows)) or [[]] * 7
            types = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["form", "original", "of_run", "n_original", "d_original", "wide", "rank"])

    return run


def _direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that show by themselves: bytes read in pairs, or characters already lost."""
    for batch in batches:
        tokens, originals = [], []
        for word in batch.column("token").to_pylist():
            whole = _PAIRED.sub(lambda m: paired_bytes(m.group()) or m.group(), word)
            if whole != word or _LOST in word:
                tokens.append(word)
                originals.append(whole if whole != word else None)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(originals, pa.string())], ["token", "original"])


def _join_forms(vocabulary: DataFrame) -> DataFrame:
    """(token, run, original, wide): words and runs of the vocabulary that are garbled forms of others, with the
    likeliest original."""
    size = vocabulary.count()
    # pairs of characters: bounded by the scripts in use
    pairs = Bitmap.gather(vocabulary.select("token").mapInArrow(_pair_hashes, "h long"), size=PAIRS)
    tokens = Bitmap.gather(vocabulary.select("token").mapInArrow(_token_hashes, "h long"), size=size)
    # few words, but much work each
    shared = vocabulary.repartition(max(1, min(MOST_TASKS, -(-size // TASK_WORDS))), "token")
    schema = "form string, original string, of_run boolean, n_original long, d_original long, wide boolean, rank int"
    forms = shared.mapInArrow(_forms(pairs, tokens), schema)
    joined = vocabulary.join(forms, (F.col("token") == F.col("form")) & (F.col("run") == F.col("of_run")))
    # the original stands in more distinct values; copies decide only where those are as many
    more = (F.col("d_original") > F.col("d")) | ((F.col("d_original") == F.col("d")) & (F.col("n_original") > F.col("n")))
    best = joined.where(F.col("wide") | more).groupBy("token", "run").agg(F.max(F.struct("wide", "rank", "d_original", "n_original", "original")).alias("b"))
    return best.select("token", "run", F.col("b.original").alias("original"), F.col("b.wide").alias("wide"))


def _resolved(found: DataFrame, steps: int = DEPTH) -> DataFrame:
    """(token, original, ...) with every original that is garbled UTF-8 itself replaced by its own, ``steps`` times."""
    for _ in range(steps):
        own = found.where("wide").select("run", F.col("token").alias("original"), F.col("original").alias("__next"))
        found = found.join(own, ["run", "original"], "left").withColumn("original", F.coalesce(F.when(F.col("__next") != F.col("token"), F.col("__next")), "original")).drop("__next")
    return found


class EncodingRepair:
    """Garbled values of the given text columns.

    key: id column; fields: text columns. Null and empty values are never garbled. A
    row given twice is reported once. Other columns are ignored.
    """

    def __init__(self, df: DataFrame, key: str, fields: tuple[str, ...]):
        values = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]))
        self._values = df.select(F.col(key).alias("id"), values.alias("v")).select("id", "v.*").where(
            F.col("id").isNotNull() & F.col("value").rlike(r"[^\x00-\x7F]")
        )
        words = F.array_distinct(F.regexp_extract_all("value", F.lit(_WORD), F.lit(0)))
        self._words = workspace.materialize(self._values.select("id", "field_name", F.sha2("value", 256).alias("digest"), words.alias("tokens")), "words")
        self.lexicon = workspace.materialize(self._lexicon(), "lexicon")
        self._hits = workspace.materialize(self._find(), "hits")

    def _lexicon(self) -> DataFrame:
        """(token, original, weak) of every garbled word of the corpus; original is null where it is lost."""
        # n: values with a word; d: distinct values, in which copies of one content have no weight
        distinct = self._words.groupBy("digest").agg(F.first("tokens").alias("tokens"), F.count("*").alias("copies"))
        vocabulary = workspace.materialize(
            distinct.select(F.explode("tokens").alias("token"), "copies").groupBy("token").agg(F.sum("copies").alias("n"), F.count("*").alias("d")), "vocabulary"
        )
        direct = vocabulary.mapInArrow(_direct, "token string, original string")
        cut = F.explode(F.array_distinct(F.regexp_extract_all("token", F.lit(r"[^\x00-\x7F]+"), F.lit(0))))
        everywhere = vocabulary.select("n", "d", cut.alias("token")).groupBy("token").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
        both = vocabulary.withColumn("run", F.lit(False)).unionByName(everywhere.withColumn("run", F.lit(True)))
        joined = workspace.materialize(_join_forms(workspace.materialize(both, "both")), "joined")
        joined = workspace.materialize(_resolved(joined), "joined")
        known, runs = joined.where("not run"), joined.where("run and wide")
        # words never seen clean: their runs beyond ASCII, looked up the same way
        rest = vocabulary.join(known, "token", "left_anti").select("token", "n", cut.alias("run"))
        by_run = rest.join(runs.select(F.col("token").alias("run"), F.col("original").alias("was")), "run")
        patched = by_run.groupBy("token").agg(F.sort_array(F.collect_list(F.struct(F.length("run").alias("l"), "run", "was")), False).alias("parts"))
        patched = patched.select("token", F.aggregate("parts", F.col("token"), lambda acc, p: F.replace(acc, p["run"], p["was"])).alias("original"))
        weak = ~F.col("wide") & (F.char_length("token") <= 2) & ~F.col("token").rlike("[0-9]$")
        found = known.select("token", "original", weak.alias("weak")).unionByName(
            patched.select("token", "original", F.lit(False).alias("weak"))
        )
        lost = direct.join(found.select("token"), "token", "left_anti").select("token", "original", F.lit(False).alias("weak"))
        return found.unionByName(lost)

    def _find(self) -> DataFrame:
        hits = workspace.materialize(
            self._words.select("id", "field_name", F.explode("tokens").alias("token")).join(self.lexicon, "token"), "maybe"
        )
        strong = hits.where("not weak").select("id", "field_name").distinct()
        symbols = hits.where("weak")
        seen = symbols.join(strong.withColumn("sure", F.lit(1)), ["id", "field_name"], "left").groupBy("token").agg(
            (F.count("sure") / F.count("*")).alias("share")
        )
        trusted = seen.where(F.col("share") >= SYMBOL_SHARE).select("token")
        return hits.where("not weak").unionByName(
            symbols.join(trusted, "token", "left_semi").select(*hits.columns)
        )

    def found(self) -> DataFrame:
        """(id, field_name) of every value with a garbled passage."""
        return self._hits.select("id", "field_name").distinct()

    def restored(self) -> DataFrame:
        """(id, field_name, value, complete): garbled values with their words put right.

        ``complete`` is false where some passage is lost for good and stays as it was.
        """
        # the garbled words of one value
        words = self._hits.groupBy("id", "field_name").agg(
            F.collect_set(F.struct("token", "original")).alias("pairs")
        )
        schema = "id long, field_name string, value string, complete boolean"
        joined = self._values.dropDuplicates(["id", "field_name"]).join(words, ["id", "field_name"])
        return joined.select(F.col("id").cast("long").alias("id"), "field_name", "value", "pairs").mapInArrow(_restore, schema)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    word = re.compile(_WORD)
    for batch in batches:
        values, complete = [], []
        for value, pairs in zip(batch.column("value").to_pylist(), batch.column("pairs").to_pylist()):
            table = {p["token"]: p["original"] for p in pairs}
            values.append(word.sub(lambda m, t=table: t.get(m.group()) or m.group(), value))
            complete.append(all(x is not None and _LOST not in x for x in table.values()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("field_name"), pa.array(values, pa.string()), pa.array(complete)],
            ["id", "field_name", "value", "complete"],
        )
