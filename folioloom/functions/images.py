"""Sizes of PNG, JPEG, GIF and WebP images from their headers, and resizing.

Sizes need no decoder. Resizing decodes PNG images of 8 bits, not interlaced, here; others need the imaging library
of the executors' Python, and come out null where there is none.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructType

SIZE = StructType().add("width", IntegerType()).add("height", IntegerType()).add("format", StringType())
#: Start-of-frame markers of JPEG; C4, C8 and CC mean other things.
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def image_size(raw: bytes | None) -> tuple[int | None, int | None, str | None]:
    """(width, height, format), or nulls where the header can't be read."""
    raw = bytes(raw or b"")
    try:
        if raw[:8] == b"\x89PNG\r\n\x1a\n":
            return (*struct.unpack(">II", raw[16:24]), "png")
        if raw[:3] == b"GIF":
            return (*struct.unpack("<HH", raw[6:10]), "gif")
        if raw[:4] == b"RIFF" and raw[8:12] == b"WEBP":
            if raw[12:16] == b"VP8X":
                return int.from_bytes(raw[24:27], "little") + 1, int.from_bytes(raw[27:30], "little") + 1, "webp"
            if raw[12:16] == b"VP8L":
                bits = int.from_bytes(raw[21:25], "little")
                return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1, "webp"
            w, h = struct.unpack("<HH", raw[26:30])
            return w & 0x3FFF, h & 0x3FFF, "webp"
        if raw[:2] == b"\xff\xd8":
            at = 2
            while at + 9 <= len(raw):
                if raw[at] != 0xFF:
                    break
                if raw[at + 1] in _FRAMES:
                    h, w = struct.unpack(">HH", raw[at + 5 : at + 9])
                    return w, h, "jpeg"
                at += 2 + int.from_bytes(raw[at + 2 : at + 4])
    except struct.error:
        pass
    return None, None, None


@F.pandas_udf(SIZE)
def image_header(raw: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([image_size(x) for x in raw], columns=["width", "height", "format"])
    return out.astype({"width": "Int32", "height": "Int32"})


def decoded_png(raw: bytes) -> np.ndarray | None:
    """(height, width, 3) of a PNG, or None if it isn't of the plain kind."""
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, data, head = 8, [], None
    while at + 8 <= len(raw):
        size, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        return None
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height + 1, width + 1, channels), np.int32)  # a line and a pixel of zeros in front
    for y in range(height):
        kind, line, above = int(lines[y, 0]), lines[y, 1:].reshape(width, channels).astype(np.int32), out[y]
        own = out[y + 1]
        if kind == 0:
            own[1:] = line
        elif kind == 2:
            own[1:] = (line + above[1:]) & 255
        elif kind == 1:
            own[1:] = np.cumsum(line, axis=0) & 255
        else:
            for x in range(width):
                left, up, corner = own[x], above[x + 1], above[x]
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                own[x + 1] = (line[x] + guess) & 255
    pixels = out[1:, 1:].astype(np.uint8)
    return np.repeat(pixels[:, :, :1], 3, axis=2) if channels < 3 else pixels[:, :, :3]


def encoded_png(pixels: np.ndarray) -> bytes:
    """A PNG of (height, width, 3) bytes."""
    height, width = pixels.shape[:2]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = np.zeros((height, 1 + 3 * width), np.uint8)
    lines[:, 1:] = pixels.reshape(height, 3 * width)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def _weights(old: int, new: int, taps: int = 3) -> np.ndarray:
    """(new, old): windowed-sinc weights of the old places for each new one."""
    scale = max(1.0, old / new)
    centre = (np.arange(new) + 0.5) * old / new
    x = (np.arange(old)[None, :] + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < taps, np.sinc(x) * np.sinc(x / taps), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resized(pixels: np.ndarray, size: int, square: bool) -> np.ndarray:
    """(size, size, 3): stretched, or first padded with black to a square, the image in its middle."""
    if square:
        height, width = pixels.shape[:2]
        side = max(height, width)
        padded = np.zeros((side, side, 3), pixels.dtype)
        top, left = (side - height) // 2, (side - width) // 2
        padded[top : top + height, left : left + width] = pixels
        pixels = padded
    out = np.einsum("ab,bcd->acd", _weights(pixels.shape[0], size), pixels.astype(np.float64))
    out = np.einsum("ab,cbd->cad", _weights(pixels.shape[1], size), out)
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def refitted_bytes(raw: bytes | None, size: int | None, square: bool) -> bytes | None:
    if raw is None or not size or pd.isna(size):
        return None
    raw = bytes(raw)
    try:
        pixels = decoded_png(raw)
        if pixels is None:
            from PIL import Image

            pixels = np.asarray(Image.open(io.BytesIO(raw)).convert("RGB"))
        return encoded_png(resized(pixels, int(size), bool(square)))
    except (ImportError, OSError, ValueError, zlib.error, struct.error):
        return None


@F.pandas_udf(BinaryType())
def refitted(raw: pd.Series, size: pd.Series, square: pd.Series) -> pd.Series:
    """The image of `size` by `size` as PNG; null where it can't be read."""
    return pd.Series([refitted_bytes(a, b, c) for a, b, c in zip(raw, size, square, strict=True)], dtype=object)


def cropped_bytes(raw: bytes | None, box: list | None) -> bytes | None:
    """A crop (x1, y1, x2, y2, whole pixels) as PNG; null where the image can't be read."""
    if raw is None or box is None:
        return None
    try:
        pixels = decoded_png(bytes(raw))
        if pixels is None:
            from PIL import Image

            pixels = np.asarray(Image.open(io.BytesIO(bytes(raw))).convert("RGB"))
        x1, y1, x2, y2 = (int(v) for v in box)
        return encoded_png(pixels[y1:y2, x1:x2])
    except (ImportError, OSError, ValueError, zlib.error, struct.error):
        return None


@F.pandas_udf(BinaryType())
def cropped(raw: pd.Series, box: pd.Series) -> pd.Series:
    return pd.Series([cropped_bytes(a, b) for a, b in zip(raw, box, strict=True)], dtype=object)
