"""Column functions that bring differently written identifiers to one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space at either end, which plain ``trim`` leaves in place.
_EDGES = r"^[\s\u00A0\u2000-\u200B\u3000\uFEFF]+|[\s\u00A0\u2000-\u200B\u3000\uFEFF]+$"


def squeeze(col: Column) -> Column:
    """``col`` without white space of any kind at its ends."""
    return F.regexp_replace(col, _EDGES, "")


def uuid_key(col: Column) -> Column:
    """Equality key of an identifier.

    The same UUID in upper or lower case, with or without hyphens, braces, the
    ``urn:uuid:`` prefix or surrounding white space gives the same 32 digits. A
    value that is no UUID is its own key after trimming, kept apart from UUIDs by
    a leading ``=``. Null, empty and blank values give null: no identifier.
    """
    bare = squeeze(col)
    digits = F.regexp_replace(F.regexp_replace(F.lower(bare), r"^urn:uuid:", ""), r"[{}()\-\s]", "")
    return (
        F.when(bare == "", F.lit(None).cast("string"))
        .when(digits.rlike(r"^[0-9a-f]{32}$"), digits)
        .otherwise(F.concat(F.lit("="), bare))
    )


def digest_key(col: Column, digits: int = 64) -> Column:
    """The lower-case hexadecimal digits of a digest however written, else null.

    Case, an algorithm prefix (``sha256:``, ``0x``), white space and separators
    between the digits do not matter; anything but exactly ``digits`` digits is no
    digest and gives null.
    """
    bare = F.regexp_replace(F.lower(squeeze(col)), r"^(?:sha-?256|0x)\s*[:=\-]?\s*", "")
    bare = F.regexp_replace(bare, r"[\s:\-_]", "")
    return F.when(bare.rlike(f"^[0-9a-f]{{{digits}}}$"), bare)
