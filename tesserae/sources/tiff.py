"""The TIFF format by ranges: headers, chunk tables, codecs, predictors.

A file is asked for bytes by offset and length only, so that a chunk costs what it stores. Classic files and those
with 64-bit offsets are read; chunks uncompressed, deflated, LZW or PackBits, with horizontal or
floating-point differencing. JPEG and other compressions are an error that names them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Tags, field types and compressions of the file format.
TAGS = {
    "width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "strip_offsets": 273, "samples": 277, "rows_per_strip": 278, "strip_counts": 279, "planar": 284,
    "predictor": 317, "tile_width": 322, "tile_height": 323, "tile_offsets": 324, "tile_counts": 325, "format": 339, "scale": 33550, "tie": 33922,
}
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
COMPRESSIONS = {1: "none", 5: "lzw", 6: "old jpeg", 7: "jpeg", 8: "deflate", 32773: "packbits", 32946: "deflate", 34712: "jpeg 2000", 34925: "lzma", 50000: "zstd", 50001: "webp"}
#: LZW: the codes that clear the table and that end, and the widths of codes in bits.
CLEAR, END, NARROW, WIDE = 256, 257, 9, 12


def unlzw(data: bytes) -> bytes:
    """Codes of growing width, most significant bit first; a code is a string seen before and one byte more."""
    table: list[bytes] = []
    out, last, width, bits, held = [], b"", NARROW, 0, 0
    for byte in data:
        held = (held << 8 | byte) & 0xFFFFFF
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == END:
            break
        if code == CLEAR:
            table, last, width = [bytes([k]) for k in range(256)] + [b"", b""], b"", NARROW
            continue
        if not table:
            raise ValueError("LZW data doesn't begin by clearing its table")
        if code < len(table):
            word = table[code]
        elif code == len(table) and last:
            word = last + last[:1]
        else:
            raise ValueError("LZW data has a code that isn't known yet")
        out.append(word)
        if last and len(table) < 1 << WIDE:
            table.append(last + word[:1])
        last = word
        if len(table) + 1 >= 1 << width and width < WIDE:  # widths grow one code early
            width += 1
    return b"".join(out)


def unpackbits(data: bytes) -> bytes:
    """Runs: n below 128 copies n + 1 bytes, n above 128 repeats one byte 257 - n times."""
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
        else:
            out.append(data[at + 1 : at + 2] * (257 - n) if n > 128 else b"")
            at += 2 if n > 128 else 1
    return b"".join(out)


@dataclass(frozen=True)
class Header:
    """What a file says of itself. Chunks are numbered in file order: planes outermost, if there are any."""

    width: int
    height: int
    samples: int
    dtype: np.dtype
    compression: int
    predictor: int
    planar: int
    w: int  # of a chunk
    h: int
    tiled: bool
    place: tuple[float, float, float, float]  # left, top, width and height of a pixel
    offsets: tuple[int, ...]
    counts: tuple[int, ...]

    @property
    def across(self) -> int:
        return -(-self.width // self.w)

    @property
    def down(self) -> int:
        return -(-self.height // self.h)

    def at(self, k: int) -> tuple[int, int, int, int, int]:
        """plane, row0, col0, rows and columns within the image of chunk k."""
        plane, n = divmod(k, self.across * self.down)
        row0, col0 = n // self.across * self.h, n % self.across * self.w
        return plane, row0, col0, min(self.h, self.height - row0), min(self.w, self.width - col0)

    def corner(self, row0: int, col0: int) -> tuple[float, float]:
        left, top, dx, dy = self.place
        return left + col0 * dx, top - row0 * dy


def header(read: Callable[[int, int], bytes]) -> Header:
    """read(offset, length) gives that much of the file."""
    start = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    magic = struct.unpack_from(order + "H", start, 2)[0] if order and len(start) >= 8 else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    word, entry, room = ("Q", 20, 8) if big else ("I", 12, 4)
    at = struct.unpack_from(order + word, start, 8 if big else 4)[0]
    count_size = 8 if big else 2
    n = struct.unpack(order + ("Q" if big else "H"), read(at, count_size))[0]
    table, found, wanted = read(at + count_size, n * entry), {}, set(TAGS.values())
    for k in range(n):
        tag, kind = struct.unpack_from(order + "HH", table, entry * k)
        if kind not in TYPES or tag not in wanted:
            continue
        many = struct.unpack_from(order + word, table, entry * k + 4)[0]
        form = f"{order}{many}{TYPES[kind]}"
        size, value = struct.calcsize(form), entry * k + 4 + struct.calcsize(word)
        raw = table[value : value + size] if size <= room else read(struct.unpack_from(order + word, table, value)[0], size)
        found[tag] = struct.unpack(form, raw)
    get = lambda name, default=None: found.get(TAGS[name], default)
    compression, predictor = get("compression", (1,))[0], get("predictor", (1,))[0]
    if COMPRESSIONS.get(compression) not in ("none", "lzw", "deflate", "packbits") or predictor not in (1, 2, 3):
        raise ValueError(f"compression {compression} ({COMPRESSIONS.get(compression, 'unknown')}) with predictor {predictor} is not read")
    width, height = get("width")[0], get("height")[0]
    dtype = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[get('format', (1,))[0]]}{get('bits', (8,))[0] // 8}")
    if predictor == 3 and dtype.kind != "f":
        raise ValueError("the floating-point predictor stands on whole numbers")
    dx, dy = (get("scale") or (1.0, 1.0, 0.0))[:2]
    tie = get("tie") or (0.0,) * 6
    tiled = get("tile_width") is not None
    w, h = (get("tile_width")[0], get("tile_height")[0]) if tiled else (width, min(height, get("rows_per_strip", (height,))[0]))
    offsets, counts = (get("tile_offsets"), get("tile_counts")) if tiled else (get("strip_offsets"), get("strip_counts"))
    return Header(width, height, get("samples", (1,))[0], dtype, compression, predictor, get("planar", (1,))[0], w, h, tiled, (tie[3] - tie[0] * dx, tie[4] + tie[1] * dy, dx, dy), offsets, counts)


def block(head: Header, k: int, stored: bytes) -> np.ndarray:
    """Values of chunk k, (rows, columns, samples), cut to the image. A plane holds one sample."""
    _, _, _, rows, cols = head.at(k)
    samples = head.samples if head.planar == 1 else 1
    kept = head.h if head.tiled else rows
    kind = COMPRESSIONS[head.compression]
    raw = stored if kind == "none" else unlzw(stored) if kind == "lzw" else unpackbits(stored) if kind == "packbits" else zlib.decompress(stored)
    size = kept * head.w * samples * head.dtype.itemsize
    if len(raw) < size:
        raise ValueError(f"chunk {k} has {len(raw)} bytes instead of {size}")
    if head.predictor == 3:  # bytes of a row by significance, each less the one before it
        bytes_ = np.frombuffer(raw, np.uint8, size).reshape(kept, -1, samples)
        planes = np.cumsum(bytes_, 1, dtype=np.uint8).reshape(kept, head.dtype.itemsize, head.w * samples)
        values = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(head.dtype.newbyteorder(">")).reshape(kept, head.w, samples)
    else:
        values = np.frombuffer(raw, head.dtype, kept * head.w * samples).reshape(kept, head.w, samples)
        if head.predictor == 2:
            values = np.cumsum(values, 1, dtype=head.dtype.newbyteorder("="))
    return values[:rows, :cols]
