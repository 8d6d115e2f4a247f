"""Column functions on file names and paths."""

from __future__ import annotations

import os
import posixpath
import re
import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def extension(name: Column) -> Column:
    """Lower-case extension with its dot, '' where there is none; leading dots belong to the name."""
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1))


def last_dot_part(path: Column) -> Column:
    """Lower-case text after the last dot, the whole text where there is no dot."""
    return F.lower(F.element_at(F.split(path, r"\."), -1))


def extension_of_path(path: Column) -> Column:
    """Text after the last dot of a path that has something before it, else ''."""
    return F.regexp_extract(path, r".+\.([^.]+)$", 1)


def is_pdf(file_type: Column) -> Column:
    return file_type == ".pdf"


def path_depth(path: Column, base: int = 0) -> Column:
    """Slashes of the path beyond those of its base."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) - F.lit(base)


def epoch_year(seconds: Column) -> Column:
    """Year of a Unix time in the session's zone."""
    return F.year(F.from_unixtime(seconds))


def parts(path: Column) -> Column:
    """Path components; index 0 of an absolute path is ''."""
    return F.split(path, "/")


def directory_levels(path: Column, skip: int = 3, most: int = 5) -> list[Column]:
    """Columns level1 .. level<most>: the components after ``skip``, null where the path is shorter."""
    return [F.get(parts(path), F.lit(skip + k)).alias(f"level{k + 1}") for k in range(most)]


def path_name(path: Column) -> Column:
    """Last component."""
    return F.element_at(parts(path), -1)


def path_parent(path: Column) -> Column:
    """Path without its last component; null at the top."""
    return F.nullif(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit(""))


def component_count(path: Column) -> Column:
    """Components of an absolute path, the root counted."""
    return F.size(parts(path))


def normalize_path(path: Column, base: str | None = None, env: Mapping[str, str] | None = None) -> Column:
    """Trimmed path with variables, ``~``, ``.`` and ``..`` resolved, joined to ``base`` where relative.

    ``env`` (default: the driver's environment) is fixed when the column is built.
    Null and empty give ''.
    """
    known = dict(os.environ if env is None else env)
    names = "|".join(map(re.escape, sorted(filter(None, known), key=len, reverse=True)))
    variable = re.compile(rf"\$\{{({names})\}}|\$({names})") if names else None

    def one(value: str | None) -> str:
        if not value:
            return ""
        value = value.strip()
        if variable and "$" in value:
            value = variable.sub(lambda m: known[m.group(1) or m.group(2)], value)
        if value.startswith("~") and known.get("HOME") and value[1:2] in ("", "/"):
            value = known["HOME"] + value[1:]
        value = posixpath.normpath(value)
        return posixpath.normpath(posixpath.join(base, value)) if base and not value.startswith("/") else value

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(one, na_action=None)

    return run(path)


def nfc(path: Column) -> Column:
    """Composed Unicode form; ASCII values never leave the JVM's fast path twice."""

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")

    return run(path)
