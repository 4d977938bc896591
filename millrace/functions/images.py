"""Image operators behind one codec seam.

With Pillow, any format it reads; without it, 8-bit PNG is decoded and encoded by
zlib and numpy, JPEG gives its size only, and integrity is a check of structure.
Sizes, tiles and boxes are Columns in ``geometry``; only pixels are touched here.
"""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    from PIL import Image as _pillow
except ImportError:
    _pillow = None

_PNG = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


class Undecodable(ValueError):
    pass


def size_of(raw: bytes) -> tuple[int, int]:
    """Width and height from the header of a PNG or JPEG."""
    if raw[:8] == _PNG and len(raw) >= 24:
        return struct.unpack(">II", raw[16:24])
    if raw[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(raw):
            if raw[at] != 0xFF:
                break
            kind, size = raw[at + 1], struct.unpack(">H", raw[at + 2 : at + 4])[0]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", raw[at + 5 : at + 9])
                return w, h
            at += 2 + size
    raise Undecodable("neither PNG nor JPEG")


def decode(raw: bytes) -> np.ndarray:
    """Pixels as rows, columns, three channels."""
    if _pillow:
        import io

        try:
            return np.asarray(_pillow.open(io.BytesIO(raw)).convert("RGB"))
        except Exception as e:
            raise Undecodable(str(e)) from e
    w, h = size_of(raw)
    if raw[:8] != _PNG:
        raise Undecodable("pixels of this format need Pillow")
    depth, kind, data, at = raw[24], raw[25], b"", 8
    if depth != 8 or kind not in _CHANNELS or raw[28]:
        raise Undecodable("only plain 8-bit PNG is read without Pillow")
    while at + 8 <= len(raw):
        size, name = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + size]
        if name == b"IDAT":
            data += body
        if raw[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(name + body)):
            raise Undecodable("checksum")
        at += 12 + size
    try:
        rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, -1)
    except (zlib.error, ValueError) as e:
        raise Undecodable(str(e)) from e
    n = _CHANNELS[kind]
    out = _unfilter(rows[:, 0], rows[:, 1:].astype(np.int32), n).reshape(h, w, n)
    return np.repeat(out[:, :, :1], 3, axis=2) if n < 3 else out[:, :, :3]


def _unfilter(filters: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """PNG's five row predictors, undone."""
    above = np.zeros(rows.shape[1], np.int32)
    for kind, row in zip(filters, rows):
        if kind == 1:
            for c in range(n):
                row[c::n] = np.cumsum(row[c::n]) & 255
        elif kind == 2:
            row += above
        elif kind in (3, 4):
            for i in range(len(row)):
                left, up, corner = (row[i - n], above[i], above[i - n]) if i >= n else (0, above[i], 0)
                guess = (left + up) // 2
                if kind == 4:
                    p = left + up - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
                row[i] = (row[i] + guess) & 255
        row &= 255
        above = row
    return rows.astype(np.uint8)


def encode(pixels: np.ndarray, kind: str = "png") -> bytes:
    """PNG without a row predictor (lossless, and the same bytes everywhere), or JPEG where Pillow can be imported."""
    if kind == "jpeg":
        if not _pillow:
            raise Undecodable("JPEG is written with Pillow only")
        import io

        out = io.BytesIO()
        _pillow.fromarray(np.ascontiguousarray(pixels, np.uint8)).save(out, "JPEG")
        return out.getvalue()
    h, w, _ = pixels.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    raw = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(pixels, np.uint8))
    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(1 - np.abs(x), 0)


def _cubic(x: np.ndarray) -> np.ndarray:
    """Keys' kernel with a = -1/2."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


def _weights(old: int, new: int, kernel) -> np.ndarray:
    """new x old: the share of each old pixel in each new one; the kernel is as wide as what shrinks into a pixel."""
    scale = old / new
    wide = max(scale, 1.0)
    centre = (np.arange(new) + 0.5) * scale
    w = kernel((np.arange(old)[None, :] + 0.5 - centre[:, None]) / wide)
    return w / w.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, w: int, h: int, kind: str = "bilinear") -> np.ndarray:
    """Bilinear or bicubic; what shrinks is averaged over."""
    kernel = {"bilinear": _triangle, "bicubic": _cubic}[kind]
    rows = np.tensordot(_weights(pixels.shape[0], h, kernel), pixels.astype(float), axes=(1, 0))
    out = np.tensordot(_weights(pixels.shape[1], w, kernel), rows, axes=(1, 1)).transpose(1, 0, 2)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def crop(pixels: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """The part between left, top, right and bottom; black where that lies outside."""
    x0, y0, x1, y1 = box
    out = np.zeros((max(y1 - y0, 0), max(x1 - x0, 0), pixels.shape[2]), np.uint8)
    a, b, c, d = max(x0, 0), max(y0, 0), min(x1, pixels.shape[1]), min(y1, pixels.shape[0])
    if a < c and b < d:
        out[b - y0 : d - y0, a - x0 : c - x0] = pixels[b:d, a:c]
    return out


def centre_square(pixels: np.ndarray, size: int | None = None) -> np.ndarray:
    """The largest square in the middle, bicubically resized if a size is given."""
    h, w = pixels.shape[:2]
    side = min(h, w)
    out = crop(pixels, ((w - side) // 2, (h - side) // 2, (w + side) // 2, (h + side) // 2))
    return out if size is None else resize(out, size, size, "bicubic")


def rotate(pixels: np.ndarray, degrees: float) -> np.ndarray:
    """Counter-clockwise, on a canvas as large as it takes; quarter turns keep every pixel, others take the nearest, black outside."""
    if degrees % 90 == 0:
        return np.rot90(pixels, int(degrees // 90))
    h, w = pixels.shape[:2]
    turn = np.deg2rad(degrees)
    c, s = np.cos(turn), np.sin(turn)
    wide, high = (int(np.ceil(abs(p * c) + abs(q * s) - 1e-9)) for p, q in ((w, h), (h, w)))
    y, x = np.mgrid[0:high, 0:wide] + 0.5
    x, y = x - wide / 2, y - high / 2
    # Back to where each new pixel comes from; rows grow downwards.
    old_x, old_y = np.floor(c * x - s * y + w / 2).astype(int), np.floor(s * x + c * y + h / 2).astype(int)
    inside = (old_x >= 0) & (old_x < w) & (old_y >= 0) & (old_y < h)
    out = np.zeros((high, wide, pixels.shape[2]), np.uint8)
    out[inside] = pixels[old_y[inside], old_x[inside]]
    return out


def array_base64(values: np.ndarray) -> str:
    """The raw bytes of an array; its shape is the caller's."""
    return base64.b64encode(np.ascontiguousarray(values).tobytes()).decode()


def tiles(pixels: np.ndarray, size: int) -> list[np.ndarray]:
    """Square tiles, row by row."""
    return [pixels[y : y + size, x : x + size] for y in range(0, pixels.shape[0], size) for x in range(0, pixels.shape[1], size)]


def outlined(pixels: np.ndarray, box: tuple[int, int, int, int], width: int = 3) -> np.ndarray:
    """With a red outline."""
    out, (x0, y0, x1, y1), red = pixels.copy(), box, (255, 0, 0)
    for a, b, c, d in ((y0, y0 + width, x0, x1), (y1 - width, y1, x0, x1), (y0, y1, x0, x0 + width), (y0, y1, x1 - width, x1)):
        out[max(a, 0) : max(b, 0), max(c, 0) : max(d, 0)] = red
    return out


def grid(images: list[np.ndarray], per_row: int) -> np.ndarray:
    """Images on a black canvas, in cells of the largest width and height."""
    h, w = max(i.shape[0] for i in images), max(i.shape[1] for i in images)
    out = np.zeros((h * -(-len(images) // per_row), w * min(per_row, len(images)), 3), np.uint8)
    for k, i in enumerate(images):
        y, x = k // per_row * h, k % per_row * w
        out[y : y + i.shape[0], x : x + i.shape[1]] = i
    return out


def _bytes(text: str | None) -> bytes | None:
    try:
        return base64.b64decode(text, validate=False) if text else None
    except (ValueError, TypeError):
        return None


@F.pandas_udf(T.BooleanType())
def intact(contents: pd.Series) -> pd.Series:
    """The base64 text holds an image that decodes."""

    def one(s: str | None) -> bool:
        raw = _bytes(s)
        try:
            return raw is not None and (raw[:2] == b"\xff\xd8" and not _pillow and raw.rstrip(b"\0")[-2:] == b"\xff\xd9" and bool(size_of(raw)) or decode(raw) is not None)
        except Undecodable:
            return False

    return contents.map(one).astype(bool)


@F.pandas_udf(T.StructType([T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType())]))
def dimensions(contents: pd.Series) -> pd.DataFrame:
    """Width and height of a base64 image; null where there is none."""
    out = []
    for s in contents:
        try:
            out.append(size_of(_bytes(s) or b""))
        except Undecodable:
            out.append((None, None))
    return pd.DataFrame(out, columns=["w", "h"], dtype="Int32")


@F.pandas_udf(T.StringType())
def resized(contents: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    out = []
    for s, a, b in zip(contents, w, h):
        try:
            out.append(base64.b64encode(encode(resize(decode(_bytes(s) or b""), int(a), int(b)))).decode())
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StringType())
def turned(contents: pd.Series, degrees: pd.Series) -> pd.Series:
    out = []
    for s, d in zip(contents, degrees):
        try:
            out.append(s if d == 0 else base64.b64encode(encode(rotate(decode(_bytes(s) or b""), float(d)))).decode())
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def cut_tiles(contents: pd.Series, w: pd.Series, h: pd.Series, size: pd.Series) -> pd.Series:
    """Tiles of the image resized to w by h, row by row, and the whole image as a thumbnail of one tile last."""
    out = []
    for s, a, b, n in zip(contents, w, h, size):
        try:
            p = decode(_bytes(s) or b"")
            parts = [*tiles(resize(p, int(a), int(b)), int(n)), resize(p, int(n), int(n))]
            out.append([base64.b64encode(encode(t)).decode() for t in parts])
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


def _text(pixels: np.ndarray) -> str:
    return base64.b64encode(encode(pixels)).decode()


@F.pandas_udf(T.StringType())
def in_grid(contents: pd.Series, per_row: pd.Series) -> pd.Series:
    """Arrays of base64 images as one grid each; null where one does not decode or there is none."""
    out = []
    for each, n in zip(contents, per_row):
        try:
            out.append(_text(grid([decode(_bytes(s) or b"") for s in each], int(n))) if each is not None and len(each) else None)
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StringType())
def boxed(contents: pd.Series, boxes: pd.Series) -> pd.Series:
    """Images with the boxes (x0, y0, x1, y1: shares of the sides where none exceeds 1, else pixels) outlined in them."""
    out = []
    for s, each in zip(contents, boxes):
        try:
            p = decode(_bytes(s) or b"")
            h, w = p.shape[:2]
            for b in each if each is not None else ():
                x0, y0, x1, y1 = (float(b[k]) for k in ("x0", "y0", "x1", "y1"))
                by_w, by_h = (w, h) if max(x0, y0, x1, y1) <= 1 else (1, 1)
                p = outlined(p, (int(x0 * by_w), int(y0 * by_h), int(x1 * by_w), int(y1 * by_h)))
            out.append(_text(p))
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StringType())
def squared(contents: pd.Series, size: pd.Series) -> pd.Series:
    """The middle square of each image, resized to a side (0: as it is)."""
    out = []
    for s, n in zip(contents, size):
        try:
            out.append(_text(centre_square(decode(_bytes(s) or b""), int(n) or None)))
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def cut_windows(contents: pd.Series, sizes: pd.DataFrame, xs: pd.Series, ys: pd.Series, window: pd.Series, thumbnail: pd.Series) -> pd.Series:
    """Windows of the image resized first to (w0, h0), where that isn't its own size, then to (w, h); row by row, the thumbnail last."""
    out = []
    for s, w0, h0, w, h, x, y, n, more in zip(contents, sizes["w0"], sizes["h0"], sizes["w"], sizes["h"], xs, ys, window, thumbnail):
        try:
            p = decode(_bytes(s) or b"")
            if x is None or y is None:
                out.append(None)
                continue
            if (int(w0), int(h0)) != (p.shape[1], p.shape[0]):
                p = resize(p, int(w0), int(h0))
            p, n = resize(p, int(w), int(h)), int(n)
            parts = [crop(p, (int(a), int(b), int(a) + n, int(b) + n)) for b in y for a in x]
            out.append([_text(q) for q in ([*parts, resize(p, n, n)] if more else parts)])
        except Undecodable:
            out.append(None)
    return pd.Series(out, dtype=object)
