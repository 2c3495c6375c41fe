"""TIFF and PNG rasters: small codecs in numpy, and tables of tiles read window by window."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..kernels.tiles import BLOB, pack
from ..stage import prepare

#: Fixed numbers of the formats: sample types by (format, bits), and bytes of a TIFF field type.
_SAMPLES = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}
_FIELD = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}


def write_tiff(im: np.ndarray, nodata: float | None = None, block: int = 256) -> bytes:
    """A tiled, deflated TIFF (bands first or one band); integers with horizontal differences."""
    im = im[None] if im.ndim == 2 else im
    bands, height, width = im.shape
    im = np.ascontiguousarray(im.transpose(1, 2, 0))
    whole = im.dtype.kind in "iu"
    tiles = []
    for i in range(0, height, block):
        for j in range(0, width, block):
            tile = np.zeros((block, block, bands), im.dtype.newbyteorder("<"))
            part = im[i : i + block, j : j + block]
            tile[: part.shape[0], : part.shape[1]] = part
            if whole:
                tile[:, 1:] = tile[:, 1:] - tile[:, :-1]
            tiles.append(zlib.compress(tile.tobytes(), 6))
    fmt = {"u": 1, "i": 2, "f": 3}[im.dtype.kind]
    entries = [(256, 4, [width]), (257, 4, [height]), (258, 3, [im.dtype.itemsize * 8] * bands), (259, 3, [8]), (262, 3, [2 if bands == 3 else 1]), (277, 3, [bands]), (284, 3, [1]), (317, 3, [2 if whole else 1]), (322, 3, [block]), (323, 3, [block]), (324, 4, [0] * len(tiles)), (325, 4, [len(t) for t in tiles]), (339, 3, [fmt] * bands)]
    if nodata is not None:
        entries.append((42113, 2, (f"{nodata:g}" + "\0").encode()))
    head, extra = 8 + 2 + 12 * len(entries) + 4, b""
    sizes = [len(v) * _FIELD[t][1] for _, t, v in entries]
    data_at = head + sum(s + (s & 1) for s in sizes if s > 4)
    offsets, at = [], data_at
    for t in tiles:
        offsets.append(at)
        at += len(t)
    out = b"II*\0" + struct.pack("<IH", 8, len(entries))
    for (tag, kind, values), size in zip(entries, sizes, strict=True):
        values = offsets if tag == 324 else values
        raw = bytes(values) if kind == 2 else struct.pack(f"<{len(values)}{_FIELD[kind][0]}", *values)
        if size <= 4:
            out += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        else:
            out += struct.pack("<HHII", tag, kind, len(values), head + len(extra))
            extra += raw + b"\0" * (size & 1)
    return out + struct.pack("<I", 0) + extra + b"".join(tiles)


def lzw_decode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; 256 clears the table, 257 ends; a width grows one code early."""
    out, table, width, bits, held, last = [], [], 9, 0, 0, None
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            bits -= width
            code, held = held >> bits, held & ((1 << bits) - 1)
            if code == 257:
                return b"".join(out)
            if code == 256:
                table, width, last = first.copy(), 9, None
                continue
            if last is None:
                now = table[code]
            else:
                now = table[code] if code < len(table) else last + last[:1]
                table.append(last + now[:1])
            out.append(now)
            last = now
            width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


class Tiff:
    """A TIFF or BigTIFF in memory: uncompressed, deflated or LZW, stripped or tiled, interleaved; reads whole images and
    windows."""

    def __init__(self, data: bytes):
        self.data, self.end = data, {b"II": "<", b"MM": ">"}[data[:2]]
        big = struct.unpack_from(self.end + "H", data, 2)[0] == 43
        offset, number, entry, inline = ("Q", "Q", "HHQ", 8) if big else ("I", "H", "HHI", 4)
        at = struct.unpack_from(self.end + offset, data, 8 if big else 4)[0]
        self.tags = {}
        head, step = struct.calcsize(self.end + number), struct.calcsize(self.end + entry) + inline
        for k in range(struct.unpack_from(self.end + number, data, at)[0]):
            tag, kind, count = struct.unpack_from(self.end + entry, data, at + head + step * k)
            code, size = _FIELD.get(kind, ("B", 1))
            where = at + head + step * k + struct.calcsize(self.end + entry)
            if size * count > inline:
                where = struct.unpack_from(self.end + offset, data, where)[0]
            self.tags[tag] = data[where : where + count].rstrip(b"\0").decode() if kind == 2 else struct.unpack_from(f"{self.end}{count * len(code)}{code[0]}", data, where)
        get = lambda tag, default: self.tags.get(tag, (default,))[0]
        self.width, self.height, self.bands = get(256, 0), get(257, 0), get(277, 1)
        self.kind = np.dtype(self.end + _SAMPLES[(get(339, 1), get(258, 8))])
        self.codec, self.predictor, self.planar = get(259, 1), get(317, 1), get(284, 1)
        if self.codec not in (1, 5, 8, 32946) or self.planar != 1 or self.predictor not in (1, 2):
            raise NotImplementedError("TIFF compression, predictor or layout")
        self.tiled = 324 in self.tags
        self.bw, self.bh = (get(322, 0), get(323, 0)) if self.tiled else (self.width, min(get(278, self.height), self.height))
        self.nodata = float(self.tags[42113]) if 42113 in self.tags else None

    def camera(self) -> dict | None:
        """The camera of the rational-polynomial tag (92 numbers), if there is one; the projection only."""
        v = self.tags.get(50844)
        if v is None or len(v) != 92:
            return None
        # fixed order of the tag: two errors, five offsets, five scales, four polynomials
        names = ("row_offset", "col_offset", "lat_offset", "lon_offset", "alt_offset", "row_scale", "col_scale", "lat_scale", "lon_scale", "alt_scale")
        out = dict(zip(names, v[2:12], strict=True))
        return out | {k: list(v[12 + 20 * i : 32 + 20 * i]) for i, k in enumerate(("row_num", "row_den", "col_num", "col_den"))}

    def window(self, x: int, y: int, w: int, h: int) -> np.ndarray:
        """(bands, h, w) float64 with NaN for nodata and outside the image; only the blocks it touches are decoded."""
        out = np.full((self.bands, h, w), np.nan)
        across = -(-self.width // self.bw)
        starts, sizes = (self.tags[324], self.tags[325]) if self.tiled else (self.tags[273], self.tags[279])
        for by in range(max(0, y) // self.bh, -(-min(self.height, y + h) // self.bh)):
            for bx in range(max(0, x) // self.bw, -(-min(self.width, x + w) // self.bw)):
                k = by * across + bx
                raw = self.data[starts[k] : starts[k] + sizes[k]]
                raw = raw if self.codec == 1 else lzw_decode(raw) if self.codec == 5 else zlib.decompress(raw)
                rows = self.bh if self.tiled else min(self.bh, self.height - by * self.bh)
                part = np.frombuffer(raw, self.kind, rows * self.bw * self.bands).reshape(rows, self.bw, self.bands)
                if self.predictor == 2:
                    part = np.cumsum(part, axis=1, dtype=self.kind.newbyteorder("="))
                y0, x0 = by * self.bh, bx * self.bw
                i0, i1 = max(y, y0, 0), min(y + h, y0 + rows, self.height)
                j0, j1 = max(x, x0, 0), min(x + w, x0 + self.bw, self.width)
                if i1 > i0 and j1 > j0:
                    out[:, i0 - y : i1 - y, j0 - x : j1 - x] = part[i0 - y0 : i1 - y0, j0 - x0 : j1 - x0].transpose(2, 0, 1)
        if self.nodata is not None:
            out[out == self.nodata] = np.nan
        return out

    def read(self) -> np.ndarray:
        return self.window(0, 0, self.width, self.height)


def write_png(im: np.ndarray) -> bytes:
    """8- or 16-bit grey, or 8-bit colour (bands first)."""
    im = im[None] if im.ndim == 2 else im
    bands, height, width = im.shape
    depth = 8 * im.dtype.itemsize
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    rows = np.ascontiguousarray(im.transpose(1, 2, 0).astype(im.dtype.newbyteorder(">"))).reshape(height, -1)
    body = b"".join(b"\0" + r.tobytes() for r in rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, {1: 0, 2: 4, 3: 2, 4: 6}[bands], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """(bands, height, width); not interlaced, no palette."""
    at, body, info = 8, b"", None
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        info = struct.unpack(">IIBBBBB", part) if name == b"IHDR" else info
        body += part if name == b"IDAT" else b""
        at += size + 12
    width, height, depth, colour, _, _, interlaced = info
    if interlaced or colour == 3 or depth not in (8, 16):
        raise NotImplementedError("PNG layout")
    bands = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    step, line = bands * depth // 8, width * bands * depth // 8
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, line + 1)
    out = np.zeros((height, line), np.uint8)
    for i, row in enumerate(raw):
        kind, now = row[0], row[1:].astype(np.int32)
        up = out[i - 1].astype(np.int32) if i else np.zeros(line, np.int32)
        if kind == 0:
            out[i] = now
        elif kind == 2:
            out[i] = now + up
        else:
            got = np.zeros(line + step, np.int32)
            corner = np.concatenate([np.zeros(step, np.int32), up])
            for j in range(line):
                a, b, c = got[j], up[j], corner[j]
                if kind == 1:
                    add = a
                elif kind == 3:
                    add = (a + b) // 2
                else:
                    p = a + b - c
                    add = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                got[j + step] = (now[j] + add) & 255
            out[i] = got[step:]
    return out.view(">u2" if depth == 16 else "u1").reshape(height, width, bands).transpose(2, 0, 1).astype("u2" if depth == 16 else "u1")


def write_image(path: str, im: np.ndarray, nodata: float | None = None) -> None:
    """The format goes by the extension: .tif, .tiff or .png; others raise."""
    kind = os.path.splitext(path)[1].lower()
    if kind not in (".tif", ".tiff", ".png"):
        raise NotImplementedError(f"no image format for {kind!r}")
    with open(path, "wb") as f:
        f.write(write_png(im) if kind == ".png" else write_tiff(im, nodata))


def read_windows(spark: SparkSession, path: str, tiles: DataFrame, keys: list[str], band: int = 0) -> DataFrame:
    """Blob rows (keys, h, w, data) of the tiles' windows (x, y, w, h) of one image.

    The plan's tiles (some thousands of small rows for an image) are read by the driver; the image is decoded in one
    task, block by block, and its tiles are then dealt out.
    """
    prepare(spark)
    types = dict(tiles.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], BLOB])
    plan = tiles.select(*dict.fromkeys([*keys, "x", "y", "w", "h"])).toPandas()

    def run(batches) -> Iterator[pd.DataFrame]:
        for part in batches:
            for content in part["content"]:
                tiff = Tiff(content)
                for at in range(0, len(plan), 16):
                    some = plan.iloc[at : at + 16]
                    out = [pack(tiff.window(int(t.x), int(t.y), int(t.w), int(t.h))[band]) for t in some.itertuples()]
                    yield some[keys].assign(h=[o[0] for o in out], w=[o[1] for o in out], data=[o[2] for o in out])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema).repartition(*keys)
