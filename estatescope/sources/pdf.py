"""Text and fonts of PDF files by the standard library alone.

Reads the objects of a file, those in compressed object streams included, and of the
filters only Flate, which nearly all text is packed with. Encrypted files and other filters give no
text. Strings are decoded by the ToUnicode table of their font where it has one.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)(?:endobj|(?=\d+\s+\d+\s+obj\b)|\Z)", re.S)
_STREAM = re.compile(rb"\bstream\r?\n")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_TOKEN = re.compile(
    rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/<>\[\]()%{}]+|\[|\]|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S
)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: Shift within an array, in thousandths of the font size, that parts words; rows moved by one of these operators.
_GAP, _MOVES = -200.0, (b"Td", b"TD", b"T*", b"Tm", b"'", b'"')


class Unreadable(ValueError):
    """No PDF, or one this reader can't take."""


@dataclass
class Pdf:
    """Objects of a file by number."""

    objects: dict[int, bytes] = field(default_factory=dict)

    @staticmethod
    def load(raw: bytes) -> Pdf:
        if not raw.lstrip()[:5].startswith(b"%PDF-"):
            raise Unreadable("no PDF")
        pdf = Pdf({int(n): body for n, body in _OBJECT.findall(raw)})
        if re.search(rb"/Encrypt\s+\d", raw):
            raise Unreadable("encrypted")
        for body in list(pdf.objects.values()):
            head = _STREAM.split(body, 1)[0]
            if b"/ObjStm" in head:
                pdf._unpack(head, body)
        return pdf

    def _unpack(self, head: bytes, body: bytes) -> None:
        data = self.data(body)
        first = re.search(rb"/First\s+(\d+)", head)
        if data is None or first is None:
            return
        start = int(first.group(1))
        numbers = [int(x) for x in data[:start].split()]
        places = list(zip(numbers[::2], numbers[1::2]))
        for (n, at), (_, end) in zip(places, [*places[1:], (0, len(data) - start)]):
            self.objects.setdefault(n, data[start + at : start + end])

    def data(self, body: bytes) -> bytes | None:
        """Contents of a stream, unpacked."""
        parts = _STREAM.split(body, 1)
        if len(parts) < 2:
            return None
        head, raw = parts
        raw = raw.rsplit(b"endstream", 1)[0]
        filters = re.search(rb"/Filter\s*(\[[^\]]*\]|/\w+)", head)
        if filters is None:
            return raw
        if re.findall(rb"/\w+", filters.group(1)) not in ([b"/FlateDecode"], [b"/Fl"]) or b"/Predictor" in head:
            return None
        try:
            return zlib.decompressobj().decompress(raw)
        except zlib.error:
            return None

    def value(self, holder: bytes, name: bytes) -> bytes:
        """What a dictionary has under a name, references followed; b'' if nothing."""
        at = re.search(rb"/" + name + rb"(?![A-Za-z0-9])\s*", holder)
        if at is None:
            return b""
        rest = holder[at.end() :]
        ref = _REF.match(rest)
        if ref:
            return self.objects.get(int(ref.group(1)), b"")
        if rest.startswith(b"<<"):
            depth = 0
            for m in re.finditer(rb"<<|>>", rest):
                depth += 1 if m.group() == b"<<" else -1
                if not depth:
                    return rest[: m.end()]
        if rest.startswith(b"["):
            return rest[: rest.find(b"]") + 1]
        return (re.match(rb"/?[^\s/<>\[\]()]+", rest) or re.match(rb"", rest)).group()

    def pages(self) -> list[bytes]:
        """Page dictionaries in the order of their tree, or of their numbers where the tree is broken."""
        is_page = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
        out: list[bytes] = []

        def walk(n: int, seen: frozenset[int]) -> None:
            body = self.objects.get(n, b"")
            if is_page.search(body):
                out.append(body)
            elif n not in seen:
                for k in _REF.findall(self.value(body, b"Kids")):
                    walk(int(k), seen | {n})

        for body in self.objects.values():
            root = re.search(rb"/Type\s*/Catalog\b", body) and re.search(rb"/Pages\s+(\d+)", body)
            if root:
                walk(int(root.group(1)), frozenset())
                break
        return out or [b for _, b in sorted(self.objects.items()) if is_page.search(_STREAM.split(b, 1)[0])]

    def resources(self, page: bytes) -> bytes:
        """Resources of a page, its own or those of the tree above."""
        for _ in range(50):
            found = self.value(page, b"Resources")
            if found:
                return found
            page = self.value(page, b"Parent")
            if not page:
                break
        return b""

    def fonts(self, page: bytes) -> dict[bytes, dict[int, str]]:
        """ToUnicode table of every font of a page, empty where it has none."""
        listed = self.value(self.resources(page), b"Font")
        out = {}
        for name, n in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R\b", listed):
            table = self.value(self.objects.get(int(n), b""), b"ToUnicode")
            out[name] = _to_unicode(self.data(table) or b"") if table else {}
        return out

    def text(self, page: bytes) -> str:
        """Text of a page, line by line."""
        contents = self.value(page, b"Contents")
        bodies = [contents] if _STREAM.search(contents) else [self.objects.get(int(n), b"") for n in _REF.findall(contents)]
        return _shown(b"\n".join(self.data(b) or b"" for b in bodies), self.fonts(page))


def _to_unicode(table: bytes) -> dict[int, str]:
    out: dict[int, str] = {}
    utf16 = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "ignore")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", table, re.S):
        for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<((?:[0-9A-Fa-f]{2})+)>", block):
            out[int(a, 16)] = utf16(b)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", table, re.S):
        for a, z, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<((?:[0-9A-Fa-f]{2})+)>", block):
            first = utf16(b)
            if first:
                for i in range(min(int(z, 16) - int(a, 16), 0xFFFF) + 1):
                    out[int(a, 16) + i] = first[:-1] + chr(min(ord(first[-1]) + i, 0x10FFFF))
    return out


def _string(token: bytes, table: dict[int, str]) -> str:
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        octal = lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1).isdigit() else _ESCAPES.get(m.group(1), m.group(1).strip(b"\r\n"))
        raw = re.sub(rb"\\([0-7]{1,3}|\r\n|.)", octal, token[1:-1], flags=re.S)
    if not table:
        return raw.decode("cp1252", "ignore")
    width = 2 if max(table) > 255 or token.startswith(b"<") and len(raw) % 2 == 0 and all(b == 0 for b in raw[::2]) else 1
    return "".join(table.get(int.from_bytes(raw[i : i + width], "big"), "") for i in range(0, len(raw), width))


def _shown(content: bytes, fonts: dict[bytes, dict[int, str]]) -> str:
    out: list[str] = []
    held: list[bytes] = []
    table: dict[int, str] = {}
    shown = False
    for m in _TOKEN.finditer(content):
        t = m.group()
        if t[:1] in b"(<[]/" or re.match(rb"[-+.\d]", t):
            held.append(t)
            continue
        if t == b"Tf":
            table = fonts.get(next((x[1:] for x in held if x.startswith(b"/")), b""), {})
        if t in _MOVES or t == b"ET":
            if shown:
                out.append("\n")
            shown = False
        if t in (b"Tj", b"TJ", b"'", b'"'):
            for x in held:
                if x[:1] in (b"(", b"<"):
                    out.append(_string(x, table))
                elif t == b"TJ" and re.match(rb"[-+.\d]", x) and float(x) < _GAP:
                    out.append(" ")
            shown = True
        held = []
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip("\n")
