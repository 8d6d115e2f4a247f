"""Pictures without a picture library: grey values of PNG, BMP and PNM files, and four-cornered outlines.

Other formats are read through a picture library where one is installed.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Weak and strong gradient of an edge, and how far a simplified outline may stray, as a share of its length.
WEAK, STRONG, STRAY = 50, 150, 0.02
#: Share of an outline's hull that edge pixels must lie along, and share of the picture below which outlines don't matter.
CLOSED, LEAST_SHARE = 0.9, 0.05
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _grey(rows: np.ndarray) -> np.ndarray:
    """Grey values of rows of grey, RGB or RGBA pixels."""
    if rows.shape[2] < 3:
        return rows[:, :, 0]
    return np.round(rows[:, :, :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def _png(raw: bytes) -> np.ndarray | None:
    at, data, palette = 8, b"", None
    wide = high = kind = 0
    while at + 8 <= len(raw):
        size, name = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + size]
        if name == b"IHDR":
            wide, high, depth, kind, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if depth != 8 or interlace or kind not in _CHANNELS:
                return None
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            data += body
        at += 12 + size
    step = _CHANNELS[kind]
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(high, 1 + wide * step)
    out = np.zeros((high + 1, wide * step), np.uint8)
    for y in range(high):
        how, line, above = lines[y, 0], lines[y, 1:], out[y]
        if how == 0:
            out[y + 1] = line
        elif how == 1:
            # each channel adds up along the line
            out[y + 1] = np.cumsum(line.reshape(wide, step), axis=0, dtype=np.uint8).ravel()
        elif how == 2:
            out[y + 1] = line + above
        else:
            own = out[y + 1]
            for x in range(wide * step):
                a = int(own[x - step]) if x >= step else 0
                b = int(above[x])
                if how == 3:
                    guess = (a + b) // 2
                else:
                    c = int(above[x - step]) if x >= step else 0
                    p, q, r = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if p <= q and p <= r else b if q <= r else c
                own[x] = (int(line[x]) + guess) & 255
    pixels = out[1:].reshape(high, wide, step)
    return _grey(palette[pixels[:, :, 0]] if kind == 3 and palette is not None else pixels)


def _bmp(raw: bytes) -> np.ndarray | None:
    start = struct.unpack("<I", raw[10:14])[0]
    head, wide, high = struct.unpack("<Iii", raw[14:26])
    bits, packed = struct.unpack("<HI", raw[28:34])
    if packed not in (0, 3) or bits not in (8, 24, 32):
        return None
    width = (wide * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(raw, np.uint8, width * abs(high), start).reshape(abs(high), width)[:, : wide * bits // 8].reshape(abs(high), wide, bits // 8)
    if high > 0:
        rows = rows[::-1]
    if bits == 8:
        palette = np.frombuffer(raw, np.uint8, start - 14 - head, 14 + head).reshape(-1, 4)
        rows = palette[rows[:, :, 0]]
    return _grey(rows[:, :, 2::-1])


def _pnm(raw: bytes) -> np.ndarray | None:
    fields: list[bytes] = []
    at = 0
    while len(fields) < 4:
        end = at
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        if raw[at : at + 1] == b"#":
            at = raw.index(b"\n", at) + 1
            continue
        if end > at:
            fields.append(raw[at:end])
        elif end >= len(raw):
            return None
        at = end + 1
    wide, high, most = (int(x) for x in fields[1:])
    if most > 255:
        return None
    step = 3 if fields[0] == b"P6" else 1
    return _grey(np.frombuffer(raw, np.uint8, wide * high * step, at).reshape(high, wide, step))


def read_grey(path: str) -> np.ndarray | None:
    """Grey picture of a file; None if it is missing, broken or of a format that can't be read here."""
    try:
        with open(path, "rb") as f:
            raw = f.read()
        for mark, read in ((b"\x89PNG\r\n\x1a\n", _png), (b"BM", _bmp), (b"P5", _pnm), (b"P6", _pnm)):
            if raw.startswith(mark):
                found = read(raw)
                if found is not None:
                    return found
        from PIL import Image

        return np.asarray(Image.open(path).convert("L"))
    except Exception:
        return None


def edges(image: np.ndarray) -> np.ndarray:
    """Edge pixels: ridges of the gradient that are strong, or weak and linked to strong ones."""
    x = np.pad(image.astype(np.int32), 1, mode="edge")
    right, left = x[:, 2:], x[:, :-2]
    gx = (right - left)[:-2] + 2 * (right - left)[1:-1] + (right - left)[2:]
    low, high = x[2:], x[:-2]
    gy = (low - high)[:, :-2] + 2 * (low - high)[:, 1:-1] + (low - high)[:, 2:]
    size = np.abs(gx) + np.abs(gy)
    g = np.pad(size, 1)
    flat, steep = np.abs(gy) <= np.tan(np.pi / 8) * np.abs(gx), np.abs(gx) <= np.tan(np.pi / 8) * np.abs(gy)
    rising = (gx > 0) == (gy > 0)
    ahead = np.select([flat, steep, rising], [g[1:-1, 2:], g[2:, 1:-1], g[2:, 2:]], g[2:, :-2])
    behind = np.select([flat, steep, rising], [g[1:-1, :-2], g[:-2, 1:-1], g[:-2, :-2]], g[:-2, 2:])
    ridge = (size >= WEAK) & (size >= ahead) & (size > behind)
    label = pieces(ridge)
    kept = np.unique(label[ridge & (size >= STRONG)])
    return ridge & np.isin(label, kept)


def pieces(mask: np.ndarray) -> np.ndarray:
    """Number of the connected piece of every marked pixel, -1 elsewhere."""
    number = np.full(mask.shape, -1, np.int64)
    number[mask] = np.arange(int(mask.sum()))
    pairs = []
    for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1)):
        a = number[: number.shape[0] - dy, max(0, -dx) : number.shape[1] - max(0, dx)]
        b = number[dy:, max(0, dx) : number.shape[1] - max(0, -dx)]
        both = (a >= 0) & (b >= 0)
        pairs.append(np.stack([a[both], b[both]]))
    a, b = np.concatenate(pairs, axis=1)
    root = np.arange(int(mask.sum()))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    number[mask] = root
    return number


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points, in order."""
    points = np.unique(points, axis=0)

    def half(ps: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1])).reshape(-1, 2)


def _simplified(line: np.ndarray, stray: float) -> list[int]:
    """Numbers of the points kept of an open line, the last left out."""
    if len(line) < 3:
        return [0]
    way = line[-1] - line[0]
    length = np.hypot(*way)
    off = line[1:-1] - line[0]
    far = np.abs(off[:, 0] * way[1] - off[:, 1] * way[0]) / length if length else np.hypot(off[:, 0], off[:, 1])
    k = int(far.argmax()) + 1
    if far[k - 1] <= stray:
        return [0]
    return _simplified(line[: k + 1], stray) + [k + i for i in _simplified(line[k:], stray)]


def outline_share(image: np.ndarray) -> float:
    """Largest share of the picture that one closed, four-cornered outline covers."""
    mask = edges(image)
    # a slanted edge may have gaps of a pixel
    wide = np.pad(mask, 1)
    label = pieces(np.logical_or.reduce([wide[dy : dy + mask.shape[0], dx : dx + mask.shape[1]] for dy in range(3) for dx in range(3)]))
    best, area = 0.0, float(image.shape[0] * image.shape[1])
    y, x = np.nonzero(mask)
    own = label[y, x]
    order = np.argsort(own, kind="stable")
    for piece in np.split(order, np.flatnonzero(np.diff(own[order])) + 1) if len(order) else []:
        points = np.stack([x[piece], y[piece]], axis=1).astype(np.float64)
        high, wide = np.ptp(points[:, 1]), np.ptp(points[:, 0])
        if high * wide < LEAST_SHARE * area:
            continue
        ring = hull(points)
        nexts = np.roll(ring, -1, axis=0)
        share = abs(float((ring[:, 0] * nexts[:, 1] - ring[:, 1] * nexts[:, 0]).sum())) / 2 / area
        length = float(np.hypot(*(nexts - ring).T).sum())
        if share <= best:
            continue
        # along the hull there must be edges, or the outline is open
        steps = np.concatenate([a + (b - a) * np.linspace(0, 1, max(2, int(np.hypot(*(b - a)))))[:, None] for a, b in zip(ring, nexts)])
        near = np.zeros((image.shape[0] + 6, image.shape[1] + 6), bool)
        for dy in range(7):
            for dx in range(7):
                near[y[piece] + dy, x[piece] + dx] = True
        if near[np.round(steps[:, 1]).astype(int) + 3, np.round(steps[:, 0]).astype(int) + 3].mean() < CLOSED:
            continue
        start = int(np.hypot(*(ring - ring.mean(axis=0)).T).argmax())
        ring = np.roll(ring, -start, axis=0)
        across = int(np.hypot(*(ring - ring[0]).T).argmax())
        closed = np.concatenate([ring, ring[:1]])
        corners = len(_simplified(closed[: across + 1], STRAY * length)) + len(_simplified(closed[across:], STRAY * length))
        if corners == 4:
            best = share
    return best
