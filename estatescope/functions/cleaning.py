"""Column functions that clean values, texts and service replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^\s+|\s+$"
UNKNOWN = "Desconocido"
#: Keys under which a reply may carry its text, in order of preference.
TEXT_KEYS = ("text", "content", "extracted_text", "ocr_text", "text_content")


def strip(col: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(col, _EDGES, "")


def safe_str(col: Column, default: str | None = "") -> Column:
    """Trimmed text; ``default`` for null only."""
    return F.coalesce(strip(col), F.lit(default).cast("string"))


def safe_int(col: Column, default: int | None = None) -> Column:
    """Integer value; ``default`` where there is none ('4.7' is none)."""
    return F.coalesce(col.try_cast("int"), F.lit(default).cast("int"))


def safe_bool_text(col: Column, default: bool = False) -> Column:
    """True for t, true and 1 in any case, ``default`` for null."""
    return F.when(col.isNull(), F.lit(default)).otherwise(F.lower(col).isin("t", "true", "1"))


def safe_bool(col: Column, default: bool = False) -> Column:
    """Boolean or number as boolean, ``default`` for null."""
    return F.coalesce(col.cast("boolean"), F.lit(default))


def truthy_flag(col: Column) -> Column:
    """Whether a flag text says yes (1, true, yes)."""
    return F.lower(strip(col)).isin("1", "true", "yes")


def sanitize_text(col: Column, most: int = 3000) -> Column:
    """Control characters but line feeds as blanks, cut to ``most`` characters with a note; null gives ''."""
    text = F.regexp_replace(F.coalesce(col, F.lit("")), r"[\x00-\x09\x0b-\x1f\x7f]", " ")
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(" …[truncated]…"))).otherwise(text)


def excerpt_cap(col: Column, most: int = 8000) -> Column:
    """First ``most`` characters."""
    return F.substring(col, 1, most)


def join_parts(parts: Column, most: int = 8000) -> Column:
    """Parts on lines of their own, capped."""
    return excerpt_cap(F.array_join(parts, "\n"), most)


def strip_json_fence(col: Column) -> Column:
    """Reply without a Markdown fence around it."""
    text = strip(col)
    text = F.regexp_replace(text, r"^```(?:json)?\s*", "")
    return strip(F.regexp_replace(text, r"\s*```$", ""))


def classification(col: Column) -> Column:
    """struct<categoria, anio, proyecto> of a reply; absent, null or unreadable fields become the unknown mark."""
    parsed = F.from_json(strip_json_fence(col), "categoria string, anio string, proyecto string")
    return F.struct(*[F.coalesce(parsed[k], F.lit(UNKNOWN)).alias(k) for k in ("categoria", "anio", "proyecto")])


def result_text(status: Column, result: Column) -> Column:
    """Text of a service result: null unless successful; of a JSON object the first text among
    its text keys, else the object as it was sent; any other result as it is."""
    json = F.try_parse_json(result)
    is_object = F.coalesce(F.schema_of_variant(json).startswith("OBJECT"), F.lit(False))
    found = F.coalesce(
        *[
            F.when(F.schema_of_variant(F.try_variant_get(json, f"$.{k}", "variant")) == "STRING", F.try_variant_get(json, f"$.{k}", "string"))
            for k in TEXT_KEYS
        ]
    )
    return F.when(status == "success", F.when(is_object, F.coalesce(found, result)).otherwise(result))


def l2_to_cosine(distance: Column) -> Column:
    """Cosine similarity of unit vectors at an L2 distance, within [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.lit(1.0) - distance * distance / 2))


def prompt(path: Column, file_type: Column, year: Column, excerpt: Column, most: int = 500) -> Column:
    """Classification request for one file; excerpt and path are capped."""
    return F.concat(
        F.lit("Classify the document and answer with JSON keys categoria, anio, proyecto.\npath: "),
        sanitize_text(path, most), F.lit("\ntype: "), F.coalesce(file_type, F.lit("")),
        F.lit("\nyear: "), F.coalesce(year.cast("string"), F.lit("")), F.lit("\ntext: "), sanitize_text(excerpt, most),
    )
