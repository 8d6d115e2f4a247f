"""What scanning leaves in a text, line by line: cut words, page numbers, running headers, misread words.

Pure functions on one text; the operator in ``scan_repair`` supplies what the corpus knows.
"""

from __future__ import annotations

import itertools
import re
from difflib import SequenceMatcher

#: A word: letters, and digits or @ that may stand for letters.
WORD = re.compile(r"[^\W\d_](?:[^\W_]|@)*|(?:\d|@)(?:[^\W_]|@)*[^\W\d_](?:[^\W_]|@)*")
_HYPHEN = r"[-¬­‐]"
CUT = re.compile(rf"([^\W\d_]+)[ \t]?{_HYPHEN}[ \t]*\r?\n[ \t]*([^\W\d_]+)")
_ROMAN = re.compile(r"(?=[ivxlc])(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_PAGE = re.compile(
    r"(?:p\. ?\d{1,4}|[—–-] ?\d{1,4} ?[—–-]|(?:página|page|pág\.|pag\.)\s*\d{1,4}(?:\s*(?:de|of|sur|/)\s*\d{1,4})?"
    r"|\d{1,4}\s?/\s?\d{1,4}|\[\d{1,4}\]|([^\x00-\x7f]{1,6}) ?\d{1,4} ?\1|p[^\x00-\x7f]{1,6}gina\s*\d{1,4}(?:\s*(?:de|/)\s*\d{1,4})?)",
    re.I,
)
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]{2,}(?: [^\W\d_a-zß-öø-ÿ]{2,})+")


def odd(word: str) -> bool:
    """Whether a word holds a digit or @, so that it is a code or misread."""
    return not word.isalpha()


def page_lines(lines: list[str]) -> list[int]:
    """Numbers of the lines that are page numbers: alone on their line, text before and after.

    A bare number counts where a running header follows or where it grows, by at most
    three, from or to another bare number of the text, or where it parts running text;
    years (19xx, 20xx) are no page numbers; roman numerals from two letters on.
    """
    marked, bare = [], []
    full = [bool(x.strip()) for x in lines]
    for i, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) > 24 or not any(full[:i]) or not any(full[i + 1 :]):
            continue
        if _PAGE.fullmatch(s):
            marked.append(i)
        elif 2 <= len(s) <= 7 and _ROMAN.fullmatch(s):
            marked.append(i)
        elif s.isascii() and s.isdigit() and (len(s) <= 3 or len(s) == 4 and s[:2] not in ("19", "20")):
            bare.append(i)
    values = [int(lines[i]) for i in bare]
    for i, n in zip(bare, values):
        if any(0 < abs(n - m) <= 3 for m in values) or i + 1 < len(lines) and _headed(lines[i + 1]) or _between(lines, i):
            marked.append(i)
    return sorted(marked)


def _running(line: str, small: int) -> bool:
    """Whether a line is running text: three words or more, ``small`` of them in small letters, no columns, few figures."""
    s = line.strip()
    words = WORD.findall(s)
    if len(words) < 3 or sum(w[0].islower() for w in words) < small or "|" in s or re.search(r"\t|\s{3}", s):
        return False
    return sum(any(c.isdigit() for c in x) for x in s.split()) * 3 <= len(s.split())


def _between(lines: list[str], i: int) -> bool:
    """Whether line ``i`` parts running text: a sentence goes on around it, or one ends before it and another begins."""
    before = next((x.rstrip() for x in lines[i - 1 :: -1] if x.strip()), "") if i else ""
    after = next((x.strip() for x in lines[i + 1 :] if x.strip()), "")
    if not lines[i - 1].strip() or not _running(before, 2) or not _running(after, 1):
        return False
    item = re.compile(r"\s*(?:\d{1,3}[.)]|[-*•])\s+")
    # a number of a list: its neighbours are items with marks of their own
    if item.match(before) and item.match(after):
        return False
    after = item.sub("", after, count=1)
    if before[-1] in ".!?»”":
        return after[:1].isupper() or after[:1] in "¿¡«“"
    return (before[-1].isalpha() or before[-1] == ",") and after[:1].isalpha()


def _headed(line: str) -> bool:
    """Whether a line looks like a running header by itself: in capitals, with a middle dot, or at the top of a page."""
    return bool(_UPPER.fullmatch(line.strip())) or "·" in line or line.startswith("\f")


def _alike(a: str, b: str) -> bool:
    a, b = a.strip().casefold(), b.strip().casefold()
    return a == b or abs(len(a) - len(b)) <= 4 and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.8


def header_lines(lines: list[str], pages: list[int]) -> list[int]:
    """Numbers of the running headers: the line after a page number where it is set in
    capitals, names a section and a title (with a middle dot), or returns after another page;
    without a page number, such a line in the middle of a sentence and a short one at the top of a page."""
    after = [i + 1 for i in pages if i + 1 < len(lines) and lines[i + 1].strip() and len(lines[i + 1].strip()) <= 60]
    out = []
    for i in after:
        s = lines[i].strip()
        if _headed(lines[i]) or any(j != i and _alike(s, lines[j]) for j in after):
            out.append(i)
    for i in range(1, len(lines) - 1):
        s = lines[i].strip()
        if i in out or i in pages or not s or len(s) > 60 or not any(x.strip() for x in lines[:i]) or not any(x.strip() for x in lines[i + 1 :]):
            continue
        above, below = lines[i - 1].rstrip(), lines[i + 1].lstrip()
        inside = _running(above, 2) and (above[-1].islower() or above[-1] == ",") and _running(below, 1) and below[0].islower()
        if inside and (_UPPER.fullmatch(s) or " · " in s) or lines[i].startswith("\f") and s[-1] not in ".,;:!?" and not s[0].islower() and below[:1].isalnum():
            out.append(i)
    return sorted(out)


def cut_words(text: str) -> int:
    """How many words are cut at a line end."""
    return sum(m.group(2)[0].islower() or m.group(0).rstrip()[len(m.group(1))] in "¬­" for m in CUT.finditer(text))


def viterbi(words: list[str], table: dict[str, list[tuple[str, float]]], gain) -> list[str]:
    """The likeliest printed words of one line.

    table: misread word to its (printed word, log probability), the word itself included
    gain(v, w): how much likelier w is after v than anywhere, as a logarithm
    """
    states = [("", 0.0, [])]
    for word in words:
        new = []
        for printed, weight in table.get(word) or [(word, 0.0)]:
            score, path = max(((s + (gain(v, printed) if v else 0.0), p) for v, s, p in states), key=lambda x: x[0])
            new.append((printed, score + weight, [*path, printed]))
        states = new
    return max(states, key=lambda x: x[1])[2]


def with_case(printed: str, seen: str) -> str:
    """``printed`` in the capitals of ``seen``."""
    letters = [c for c in seen if c.isalpha()]
    if letters and len(letters) > 1 and all(c.isupper() for c in letters):
        return printed.upper()
    return printed[:1].upper() + printed[1:] if letters and letters[0].isupper() and seen[:1].isalpha() else printed


def repair(text: str, fixes: dict[tuple[int, int], str]) -> str:
    """Continuous paragraphs: without page numbers and running headers, cut words joined,
    misread words put right, ordinary line breaks within a paragraph closed.

    fixes: the word printed, by the number of the line and of the word in it
    """
    lines = text.replace("\r\n", "\n").split("\n")
    pages = page_lines(lines)
    gone = {*pages, *header_lines(lines, pages)}
    for i in {i for i, _ in fixes}:
        at = itertools.count()
        lines[i] = WORD.sub(lambda m, i=i, at=at: fixes.get((i, next(at)), m.group()), lines[i])
    kept = "\n".join(x.lstrip("\f") for i, x in enumerate(lines) if i not in gone)
    kept = CUT.sub(lambda m: m.group(1) + m.group(2) if m.group(2)[0].islower() else m.group(0), kept)
    kept = re.sub(r"[ \t]+\n", "\n", kept)
    # a line break is ordinary where a full line ends without a stop and the next begins small
    return re.sub(r"(?<=[^\n.!?:;])\n(?=[a-zß-öø-ÿ(«“¿])", " ", kept)
