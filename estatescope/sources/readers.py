"""Byte-level work by path: digests, texts, and checks of PDFs and pictures.

Everything here runs in Arrow batches on the executors and reads files in pieces of
constant size (PDFs whole). Libraries that may be absent are imported where they
are used: PDFs, and PNG, BMP and PNM pictures, are read without one as well.
"""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope.sources import pdf, pictures

PIECE = 4 * 1024 * 1024
TEXT_CAP = 8000
TEXT_TYPES = (".txt", ".md", ".csv", ".log")
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def digests(path: str, piece: int = PIECE) -> tuple[str, str] | None:
    """(xxh64 with seed 0 as signed decimal, SHA-256 in hex) in one pass, None if unreadable."""
    fast, safe = xxhash.xxh64(seed=0), hashlib.sha256()
    try:
        with open(path, "rb") as f:
            while block := f.read(piece):
                fast.update(block)
                safe.update(block)
    except OSError:
        return None
    value = fast.intdigest()
    return str(value - (1 << 64) if value >= 1 << 63 else value), safe.hexdigest()


def plain_text(path: str, cap: int = TEXT_CAP) -> str:
    """First ``cap`` characters, bytes that are no UTF-8 left out; '' if unreadable."""
    try:
        with open(path, "rb") as f:
            return f.read(4 * cap).decode("utf-8", "ignore")[:cap]
    except OSError:
        return ""


def docx_text(path: str, cap: int = TEXT_CAP) -> str:
    """Paragraphs, then table cells, one per line, capped; '' if unreadable."""
    try:
        with zipfile.ZipFile(path) as z:
            body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    except (OSError, KeyError, zipfile.BadZipFile, ElementTree.ParseError):
        return ""
    if body is None:
        return ""
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    lines = [text(p) for p in body.findall(f"{_W}p")]
    lines += [text(c) for t in body.findall(f"{_W}tbl") for c in t.iter(f"{_W}tc")]
    return "\n".join(x for x in lines if x)[:cap]


def _read(path: str) -> pdf.Pdf:
    with open(path, "rb") as f:
        return pdf.Pdf.load(f.read())


def pdf_text(path: str, cap: int = TEXT_CAP) -> str:
    """Text of the pages until the cap is reached; '' if unreadable. A PDF library is used where there is one."""
    parts, size = [], 0
    try:
        try:
            from pypdf import PdfReader

            texts = (page.extract_text() or "" for page in PdfReader(path).pages)
        except ImportError:
            own = _read(path)
            texts = (own.text(page) for page in own.pages())
        for text in texts:
            parts.append(text)
            size += len(text) + 1
            if size >= cap:
                break
    except Exception:
        return ""
    return "\n".join(parts)[:cap]


def pages_need_ocr(pages: list[dict]) -> bool:
    """True if no page has a font among its resources; pages are mappings as PDF libraries give them."""
    for page in pages:
        resources = page.get("/Resources")
        resources = resources.get_object() if hasattr(resources, "get_object") else resources
        if resources and "/Font" in resources:
            return False
    return True


def pdf_needs_ocr(path: str) -> bool | None:
    """Whether no page of a PDF has a font, so that it has no text layer; None if it is missing or broken."""
    try:
        try:
            from pypdf import PdfReader

            return pages_need_ocr(list(PdfReader(path).pages))
        except ImportError:
            own = _read(path)
            return not any(own.value(own.resources(page), b"Font") for page in own.pages())
    except Exception:
        return None


def extract_text(path: str, file_type: str | None, ocr_needed: bool | None, cap: int = TEXT_CAP) -> str | None:
    """Text of a file by its type: '' where OCR is needed or the type holds none, None if it can't be read here."""
    if ocr_needed:
        return ""
    kind = (file_type or "").lower()
    if kind in TEXT_TYPES:
        return plain_text(path, cap)
    if kind == ".docx":
        return docx_text(path, cap)
    return pdf_text(path, cap) if kind == ".pdf" else ""


def shrink(image: np.ndarray, most: int = 1024) -> np.ndarray:
    """Grey picture with its longer side at most ``most`` (whole steps)."""
    step = -(-max(image.shape[:2]) // most)
    return image[::step, ::step]


def quad_share(image: np.ndarray) -> float:
    """Largest share of the picture that one four-cornered outline covers; by OpenCV where it is installed."""
    try:
        import cv2
    except ImportError:
        return pictures.outline_share(image)
    outlines, _ = cv2.findContours(cv2.Canny(image, 50, 150), cv2.RETR_EXTERNAL, cv2.CHAIN_APPROX_SIMPLE)
    area = image.shape[0] * image.shape[1]
    four = [cv2.contourArea(c) for c in outlines if len(cv2.approxPolyDP(c, 0.02 * cv2.arcLength(c, True), True)) == 4]
    return max(four, default=0.0) / area


def looks_like_document(image: np.ndarray | None, outline: Callable[[np.ndarray], float] = quad_share) -> bool:
    """Whether a grey picture shows a document: large, not too long, one four-cornered outline of a fifth
    of it at least, little contrast overall."""
    if image is None or min(image.shape[:2]) < 200:
        return False
    high, wide = image.shape[:2]
    if max(high, wide) / min(high, wide) > 2 or float(np.std(image)) > 60:
        return False
    return outline(image) >= 0.2


def _by_row(fn: Callable, columns: list[str], names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [fn(*row) for row in batch[columns].itertuples(index=False)]
            yield pd.DataFrame({"id": batch["id"], **{n: [None if g is None else g[k] for g in got] for k, n in enumerate(names)}})

    return run


def hash_files(files: DataFrame, parallelism: int | None = None) -> DataFrame:
    """(id, xxhash64, sha256) of (id, full_path); files that cannot be read are left out."""
    todo = files.select("id", "full_path")
    todo = todo.repartition(parallelism) if parallelism else todo
    return todo.mapInPandas(_by_row(digests, ["full_path"], ["xxhash64", "sha256"]), "id long, xxhash64 string, sha256 string").where("sha256 is not null")


def check_pdfs(files: DataFrame) -> DataFrame:
    """(id, ocr_needed) of (id, full_path); undecided ones are left out."""
    one = lambda p: (pdf_needs_ocr(p),)
    return files.select("id", "full_path").mapInPandas(_by_row(one, ["full_path"], ["ocr_needed"]), "id long, ocr_needed boolean").where("ocr_needed is not null")


def read_texts(files: DataFrame, cap: int = TEXT_CAP) -> DataFrame:
    """(id, text_excerpt, text_chars_extracted) of (id, full_path, file_type, ocr_needed); unread ones are left out."""

    def one(path, kind, needed):
        text = extract_text(path, kind, None if needed is None or needed != needed else bool(needed), cap)
        return None if text is None else (text, len(text))

    schema = "id long, text_excerpt string, text_chars_extracted int"
    return files.select("id", "full_path", "file_type", "ocr_needed").mapInPandas(
        _by_row(one, ["full_path", "file_type", "ocr_needed"], ["text_excerpt", "text_chars_extracted"]), schema
    ).where("text_excerpt is not null")


def detect_documents(files: DataFrame, decode: Callable[[str], np.ndarray | None] = pictures.read_grey, outline: Callable[[np.ndarray], float] = quad_share) -> DataFrame:
    """(id) of the pictures that look like documents; ``decode`` gives the grey picture of a path or None."""

    def one(path):
        image = decode(path)
        return (None if image is None else looks_like_document(shrink(image), outline),)

    return files.select("id", "full_path").mapInPandas(_by_row(one, ["full_path"], ["hit"]), "id long, hit boolean").where("hit").select("id")


_FENCE = re.compile(r"^```(?:json)?\s*|\s*```$")


def classify(rows: DataFrame, ask: Callable[[str], str], attempts: int = 3, at_once: int | None = None) -> DataFrame:
    """(id, categoria, anio, proyecto) of (id, prompt), by a service that answers a prompt with JSON.

    Up to ``attempts`` tries per file, then the unknown mark in every field; ``at_once``
    bounds how many requests run side by side.
    """
    import json

    from estatescope.functions.cleaning import UNKNOWN

    def one(text: str) -> tuple[str, str, str]:
        for _ in range(attempts):
            try:
                got = json.loads(_FENCE.sub("", ask(text).strip()).strip())
                return tuple(str(got.get(k) if got.get(k) is not None else UNKNOWN) for k in ("categoria", "anio", "proyecto"))
            except Exception:
                continue
        return (UNKNOWN,) * 3

    todo = rows.select("id", "prompt")
    todo = todo.repartition(at_once) if at_once else todo
    return todo.mapInPandas(_by_row(one, ["prompt"], ["categoria", "anio", "proyecto"]), "id long, categoria string, anio string, proyecto string")


def chat_service(url: str, system: str = "You are an expert at classifying documents.", timeout: float = 300.0, most_tokens: int = 60, **fields) -> Callable[[str], str]:
    """A service for :func:`classify`: the chat endpoint at ``url`` is sent each prompt and its first answer returned.

    An HTTP error, a time-out or an answer of another shape raises, so that the prompt is tried again.
    """

    def ask(prompt: str) -> str:
        import json
        from urllib.request import Request, urlopen

        messages = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        body = {"messages": messages, "temperature": 0, "max_tokens": most_tokens, **fields}
        with urlopen(Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"}), timeout=timeout) as answer:  # noqa: S310
            return json.loads(answer.read())["choices"][0]["message"]["content"]

    return ask


def read_jdbc(spark, url: str, table: str, **options: str) -> DataFrame:
    """Table of a database; with partitionColumn, lowerBound, upperBound and numPartitions it is read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def binary_text(content, cap: int = TEXT_CAP):
    """Column of text from a column of bytes, in the JVM: broken sequences become replacement marks."""
    return F.substring(F.make_valid_utf8(content.cast("string")), 1, cap)
