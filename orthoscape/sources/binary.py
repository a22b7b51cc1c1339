"""Binary rasters in Arrow batches: PNG, PFM and NumPy arrays, and labels of coloured images."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_pfm(content: bytes) -> np.ndarray:
    """Height x width (x 3) floats; the sign of the scale gives the byte order and rows come bottom up."""
    kind, size, scale, data = content.split(b"\n", 3)
    if kind.strip() not in (b"PF", b"Pf"):
        raise ValueError("not a PFM file")
    w, h = map(int, size.split())
    channels = 3 if kind.strip() == b"PF" else 1
    out = np.frombuffer(data, "<f4" if float(scale) < 0 else ">f4", count=w * h * channels)
    return np.flipud(out.reshape((h, w, 3) if channels == 3 else (h, w)))


def format_pfm(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    return f"{'PF' if image.ndim == 3 else 'Pf'}\n{w} {h}\n-1.0\n".encode() + np.flipud(image).astype("<f4").tobytes()


_PNG = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel by colour type of a PNG: grey, colours, palette, grey and alpha, colours and alpha.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def parse_png(content: bytes) -> np.ndarray:
    """Height x width (x samples) integers of a PNG without interlacing; palettes become colours.

    Depths of 1, 2, 4, 8 and 16 bits; check sums are verified.
    """
    if not content.startswith(_PNG):
        raise ValueError("not a PNG file")
    at, data, palette, head = len(_PNG), [], None, None
    while at < len(content):
        n, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + n]
        if len(body) < n or zlib.crc32(kind + body) != struct.unpack(">I", content[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG file")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if head is None or head[6] or head[3] not in _SAMPLES:
        raise ValueError("no PNG without interlacing")
    w, h, depth, colour = head[:4]
    samples = _SAMPLES[colour]
    step, width = max(1, samples * depth // 8), -(-w * samples * depth // 8)
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, width + 1)
    raw, before = np.zeros((h, width), np.uint8), np.zeros(width, np.uint8)
    for y in range(h):
        before = raw[y] = _unfiltered(int(rows[y, 0]), rows[y, 1:], before, step)
    if depth == 16:
        out = raw.view(">u2").astype(np.uint16)
    elif depth == 8:
        out = raw
    else:
        bits = np.unpackbits(raw, axis=1).reshape(h, -1, depth)
        out = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(2).astype(np.uint8)[:, : w * samples]
    out = out.reshape((h, w, samples) if samples > 1 else (h, w))
    return palette[out] if colour == 3 and palette is not None else out


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A row of bytes without its filter: none, left, above, their mean, or the nearest of left, above and corner."""
    if kind == 0:
        return row.copy()
    if kind == 2:
        return row + above
    if kind == 1:
        lanes = np.zeros(-(-len(row) // step) * step, np.uint8)
        lanes[: len(row)] = row
        return np.cumsum(lanes.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)[: len(row)]
    if kind not in (3, 4):
        raise ValueError("unknown PNG filter")
    out, up = [0] * step + row.tolist(), [0] * step + above.tolist()
    for i in range(step, len(out)):
        a, b, c = out[i - step], up[i], up[i - step]
        if kind == 3:
            guess = (a + b) // 2
        else:
            by = (abs(b - c), abs(a - c), abs(a + b - 2 * c))
            guess = (a, b, c)[by.index(min(by))]
        out[i] = (out[i] + guess) & 255
    return np.array(out[step:], np.uint8)


def format_png(image: np.ndarray) -> bytes:
    """A PNG of height x width (x 2, 3 or 4) integers of 8 or 16 bits, unfiltered."""
    samples = image.shape[2] if image.ndim == 3 else 1
    colour = {n: c for c, n in _SAMPLES.items() if c != 3}[samples]
    depth = 16 if image.dtype == np.uint16 else 8
    raw = np.ascontiguousarray(image, ">u2" if depth == 16 else np.uint8).view(np.uint8).reshape(image.shape[0], -1)
    lines = np.concatenate([np.zeros((len(raw), 1), np.uint8), raw], 1)
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], depth, colour, 0, 0, 0)
    parts = [(b"IHDR", head), (b"IDAT", zlib.compress(lines.tobytes())), (b"IEND", b"")]
    return _PNG + b"".join(struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b)) for k, b in parts)


def parse_npy(content: bytes) -> np.ndarray:
    return np.load(io.BytesIO(content), allow_pickle=False)


PARSERS = {"pfm": parse_pfm, "npy": parse_npy, "png": parse_png}


def decoded(df: DataFrame, key: str, content: str, parse) -> DataFrame:
    """(key, h, w, values): one row a file; values row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            images = [parse(bytes(c)) for c in pdf[content]]
            yield pd.DataFrame({key: pdf[key], "h": [i.shape[0] for i in images], "w": [i.shape[1] for i in images], "values": [i.ravel().astype("float64").tolist() for i in images]})

    return df.select(key, content).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, h int, w int, values array<double>")


def read_rasters(spark: SparkSession, path: str, pattern: str = "*.pfm") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    parse = PARSERS[pattern.rpartition(".")[2].lower()]
    return decoded(files.select("path", "content"), "path", "content", parse)


def to_pixels(rasters: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, y, x, z) of rasters; the array is exploded in place."""
    p = rasters.select(*keys, "w", F.posexplode("values").alias("_i", "z"))
    return p.select(*keys, F.floor(F.col("_i") / F.col("w")).cast("int").alias("y"), (F.col("_i") % F.col("w")).cast("int").alias("x"), "z")


def labels_of_colours(pixels: DataFrame, palette: DataFrame) -> DataFrame:
    """Ids of r, g, b by a palette (r, g, b, id); unknown colours are 0.  A palette has at most 2**24 rows; a small one is broadcast by its size."""
    return pixels.join(palette, ["r", "g", "b"], "left").withColumn("id", F.coalesce("id", F.lit(0))).drop("r", "g", "b")
