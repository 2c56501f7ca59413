"""One PNG image per day and variable, encoded in a stream, and the way back.

Python only sees Arrow batches of (day, line, place, colours): it puts them into the lines of a strip by array
operations and feeds whole strips to one compressor an image. Days are never gathered, and a strip
is all that is held of an image but its compressed bytes.
"""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import INDICATORS, PALETTE_LABEL, REVERSED_RAMPS, ROUNDING_FACTOR
from daymosaic.functions.colour import ramp_position, with_rgb
from daymosaic.functions.text import compact_date
from daymosaic.operators.raster import scaled_layers, var_ranges, with_ranges
from daymosaic.schemas import GridSpec

#: lines of an image encoded at a time
STRIP_ROWS = 256
WHITE = 0xFFFFFF
SIGNATURE = b"\x89PNG\r\n\x1a\n"
URI = "data:image/png;base64,"
ENCODED = "date date, var string, png binary, min_value double, max_value double"
PIXELS = "date string, var string, row long, col long, colour string"


def image_legend(layers: DataFrame, target: GridSpec, variables=INDICATORS) -> DataFrame:
    """Everything of the image table but the image: date text, palette, extent, value range."""
    return _describe(var_ranges(scaled_layers(layers, variables), variables), target)


def _describe(ranges: DataFrame, target: GridSpec, *more) -> DataFrame:
    scale = F.lit(float(ROUNDING_FACTOR))
    return ranges.select(
        compact_date(F.col("date")).alias("date"), "var",
        F.lit(PALETTE_LABEL).alias("palette_selected"),
        F.lit(float(target.xmin)).alias("left_ext"), F.lit(float(target.ymin)).alias("down_ext"),
        F.lit(float(target.xmax)).alias("right_ext"), F.lit(float(target.ymax)).alias("up_ext"),
        (F.col("min_value") / scale).alias("min_value"), (F.col("max_value") / scale).alias("max_value"),
        *more,
    )


def image_table(layers: DataFrame, target: GridSpec, variables=INDICATORS, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Image rows of layers on ``target`` (date, row, col, variables).

    Rows of a day come sorted by line. Where ``layers`` are partitioned by day (``raster.by_day``) nothing moves.
    """
    variables = list(variables)
    ranged = with_ranges(scaled_layers(layers, variables), variables).sortWithinPartitions("date", "row")
    placed = ranged.select("date", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[
        c for k, v in enumerate(variables) for c in (
            F.expr(ramp_position(v, f"_min_{v}", f"_max_{v}", str(v in REVERSED_RAMPS))).alias(f"_t{k}"),
            F.col(f"_min_{v}").alias(f"_lo{k}"), F.col(f"_max_{v}").alias(f"_hi{k}"))])
    each = ", ".join(f"(_t{k}, _lo{k}, _hi{k}) AS `{k}`" for k in range(len(variables)))
    long = layers.sparkSession.sql(
        f"SELECT date, row, col, CAST(k AS INT) AS k, t, lo, hi FROM {{placed}} UNPIVOT INCLUDE NULLS ((t, lo, hi) FOR k IN ({each}))", placed=placed)
    psi = f"k = {variables.index('Psi')}" if "Psi" in variables else "false"
    pixels = with_rgb(long, "t", psi, "rgb").select("date", "row", "col", "k", F.coalesce("rgb", F.lit(WHITE)).alias("rgb"), "lo", "hi")
    images = pixels.mapInArrow(_encoder(variables, target.ncol, target.nrow, strip_rows), ENCODED)
    described = _describe(images, target, F.concat(F.lit(URI), F.base64("png")).alias("base64_string"))
    return described.select(
        "date", "var", "palette_selected", "base64_string",
        "left_ext", "down_ext", "right_ext", "up_ext", "min_value", "max_value",
    )


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


class _Day:
    """The images of one day, line by line from the top. Pixels without a value are white, and white is declared transparent."""

    def __init__(self, date, count: int, ncol: int, nrow: int, strip_rows: int):
        self.date, self.ncol, self.nrow = date, ncol, nrow
        self.ranges = np.full((2, count), np.nan)
        self.first, self.rows = 0, min(strip_rows, nrow)
        self.packers = [zlib.compressobj(6) for _ in range(count)]
        self.packed: list[list[bytes]] = [[] for _ in range(count)]
        self._clear()

    def _clear(self):
        # a line begins with the number of its filter, 0; red, green and blue follow
        self.strip = np.full((len(self.packers), self.rows, 1 + 3 * self.ncol), 255, np.uint8)
        self.strip[:, :, 0] = 0

    def put(self, k: np.ndarray, row: np.ndarray, col: np.ndarray, rgb: np.ndarray) -> None:
        """Pixels in order of their lines, none above those put before."""
        while len(row):
            last = np.searchsorted(row, self.first + self.rows)
            at = (k[:last], row[:last] - self.first, 1 + 3 * col[:last])
            for channel, shift in enumerate((16, 8, 0)):
                self.strip[at[0], at[1], at[2] + channel] = rgb[:last] >> shift & 0xFF
            k, row, col, rgb = k[last:], row[last:], col[last:], rgb[last:]
            if len(row):
                self._pack()

    def _pack(self):
        for strip, packer, packed in zip(self.strip, self.packers, self.packed):
            packed.append(packer.compress(strip.tobytes()))
        self.first += self.rows
        self.rows = min(self.rows, self.nrow - self.first)
        self._clear()

    def images(self):
        """The bytes of each image."""
        while self.first < self.nrow:
            self._pack()
        head = SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", self.ncol, self.nrow, 8, 2, 0, 0, 0)) + _chunk(b"tRNS", b"\x00\xff" * 3)
        for packer, packed in zip(self.packers, self.packed):
            yield head + _chunk(b"IDAT", b"".join(packed) + packer.flush()) + _chunk(b"IEND", b"")


def _encoder(variables: list[str], ncol: int, nrow: int, strip_rows: int):
    def finished(day: _Day) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([day.date] * len(variables), pa.int32()).cast(pa.date32()), pa.array(variables), pa.array(list(day.images()), pa.binary()),
            *[pa.array(ends, from_pandas=True) for ends in day.ranges]], names=[c.split()[0] for c in ENCODED.split(", ")])

    def encode(batches):
        day = None
        for batch in batches:
            dates = batch.column(0).cast(pa.int32()).to_numpy(zero_copy_only=False)
            row, col, k, rgb, *ranges = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 7))
            edges = np.flatnonzero(np.diff(dates)) + 1
            for begin, end in zip([0, *edges], [*edges, len(dates)]):
                if begin == end:
                    continue
                if day is None or day.date != dates[begin]:
                    if day is not None:
                        yield finished(day)
                    day = _Day(int(dates[begin]), len(variables), ncol, nrow, strip_rows)
                for ends, own in zip(day.ranges, ranges):
                    ends[k[begin:end]] = own[begin:end]
                day.put(k[begin:end], row[begin:end], col[begin:end], rgb[begin:end])
        if day is not None:
            yield finished(day)

    return encode


# --- the way back -----------------------------------------------------------------------------

def decode_png(data: bytes) -> np.ndarray:
    """Colours (line, place, 3) of an image of 8 bits a channel without filters, as written here; its checksums must hold."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG image")
    at, chunks = 8, {}
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at: at + 4]), data[at + 4: at + 8]
        body = data[at + 8: at + 8 + n]
        if struct.unpack(">I", data[at + 8 + n: at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError(f"damaged {kind!r} chunk")
        chunks[kind] = chunks.get(kind, b"") + body
        at += 12 + n
    width, height, depth, kind = struct.unpack(">IIBB", chunks[b"IHDR"][:10])
    if (depth, kind) != (8, 2) or b"IEND" not in chunks:
        raise ValueError("not an image of this table")
    lines = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), np.uint8).reshape(height, 1 + 3 * width)
    if lines[:, 0].any():
        raise ValueError("lines are filtered")
    return lines[:, 1:].reshape(height, width, 3)


def image_pixels(images: DataFrame) -> DataFrame:
    """The pixels that are not transparent of all images of a table: PIXELS."""
    def decode(batches):
        for batch in batches:
            for date, var, uri in zip(*(c.to_pylist() for c in batch.columns)):
                pixels = decode_png(base64.b64decode(uri.removeprefix(URI))).astype(np.int64)
                rgb = (pixels[:, :, 0] << 16) + (pixels[:, :, 1] << 8) + pixels[:, :, 2]
                row, col = np.nonzero(rgb != WHITE)
                yield pa.RecordBatch.from_arrays([
                    pa.array([date] * len(row), pa.string()), pa.array([var] * len(row), pa.string()), pa.array(row), pa.array(col),
                    pa.array([f"#{c:06X}" for c in rgb[row, col].tolist()], pa.string())], names=[c.split()[0] for c in PIXELS.split(", ")])

    return images.select("date", "var", "base64_string").mapInArrow(decode, PIXELS)
