"""Cutting text into pre-tokens with JVM expressions, exactly as the tokenizer does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points the tokenizer counts as letters or numbers while a
#: JVM of Unicode 13 still has them unassigned (first, last).
NEWER_LETTERS = (
    (0x870, 0x887), (0x889, 0x88E), (0x8B5, 0x8B5), (0x8C8, 0x8C9), (0xC5D, 0xC5D), (0xCDD, 0xCDD),
    (0x170D, 0x170D), (0x171F, 0x171F), (0x1B4C, 0x1B4C), (0x1C89, 0x1C8A), (0x2C2F, 0x2C2F), (0x2C5F, 0x2C5F),
    (0x9FFD, 0x9FFF), (0xA7C0, 0xA7C1), (0xA7CB, 0xA7CD), (0xA7D0, 0xA7D1), (0xA7D3, 0xA7D3), (0xA7D5, 0xA7DC),
    (0xA7F2, 0xA7F4), (0x10570, 0x1057A), (0x1057C, 0x1058A), (0x1058C, 0x10592), (0x10594, 0x10595),
    (0x10597, 0x105A1), (0x105A3, 0x105B1), (0x105B3, 0x105B9), (0x105BB, 0x105BC), (0x105C0, 0x105F3),
    (0x10780, 0x10785), (0x10787, 0x107B0), (0x107B2, 0x107BA), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x10F70, 0x10F81), (0x11071, 0x11072), (0x11075, 0x11075), (0x1123F, 0x11240),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11740, 0x11746), (0x11AB0, 0x11ABF), (0x11BC0, 0x11BE0),
    (0x11F02, 0x11F02), (0x11F04, 0x11F10), (0x11F12, 0x11F33), (0x12F90, 0x12FF0), (0x1342F, 0x1342F),
    (0x13441, 0x13446), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16A70, 0x16ABE), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1AFF0, 0x1AFF3), (0x1AFF5, 0x1AFFB), (0x1AFFD, 0x1AFFE), (0x1B11F, 0x1B122),
    (0x1B132, 0x1B132), (0x1B155, 0x1B155), (0x1DF00, 0x1DF1E), (0x1DF25, 0x1DF2A), (0x1E030, 0x1E06D),
    (0x1E290, 0x1E2AD), (0x1E4D0, 0x1E4EB), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0), (0x1E7E0, 0x1E7E6),
    (0x1E7E8, 0x1E7EB), (0x1E7ED, 0x1E7EE), (0x1E7F0, 0x1E7FE), (0x2A6DE, 0x2A6DF), (0x2B735, 0x2B739),
    (0x2EBF0, 0x2EE5D), (0x31350, 0x323AF),
)
NEWER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x11F50, 0x11F59), (0x16130, 0x16139),
    (0x16AC0, 0x16AC9), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1D2C0, 0x1D2D3), (0x1E4F0, 0x1E4F9),
    (0x1E5F1, 0x1E5FA),
)

#: White space of the tokenizer (Unicode White_Space) for a Java character class.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _ranges(table: tuple[tuple[int, int], ...]) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in table)


def java_pattern(newer: bool) -> str:
    """The pre-token pattern in Java's dialect; ``newer`` adds the newer code points."""
    letters = r"\p{L}" + (_ranges(NEWER_LETTERS) if newer else "")
    numbers = r"\p{N}" + (_ranges(NEWER_NUMBERS) if newer else "")
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def pretokens(text: Column) -> Column:
    """Array of pre-tokens whose concatenation is ``text``; null and '' give an empty array.

    Texts with code points this JVM doesn't know take the longer pattern.
    """
    text = F.coalesce(text, F.lit(""))
    cut = lambda newer: F.regexp_extract_all(text, F.lit(java_pattern(newer)), F.lit(0))
    return F.when(text.rlike(r"\p{Cn}"), cut(True)).otherwise(cut(False))
