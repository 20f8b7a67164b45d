"""GeoTIFF stacks as a Spark data source: a row (date, lats, lons, values) for each band, read by windows of bands.

Bands are dated by the YYYY-MM-DD in their descriptions. No-data pixels are NaN. Strips or tiles; uncompressed,
deflate or LZW without predictor; other layouts raise.
spark.dataSource.register(GeoTiffSource); spark.read.format("geotiff").option("paths", "a.tif,b.tif").load()
"""

from __future__ import annotations

import datetime
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridclim.sources.files import listed
from gridclim.sources.write import TiffWriter

#: Bands read by one task.
WINDOW = 30
# fixed values: field types of the format and the tags that are read
_KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, TILE_W, TILE_H, TILES, TILE_COUNTS, FORMAT, SCALE, TIE, METADATA, NODATA = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339, 33550, 33922, 42112, 42113


def lzw_decode(data: bytes) -> bytes:
    """The format's own variety: high bits first, widths change one code early."""
    table, out, width, previous = [bytes([i]) for i in range(256)] + [b"", b""], [], 9, b""
    bits, held = 0, 0
    for byte in data:
        bits, held = bits << 8 | byte, held + 8
        while held >= width:
            code = bits >> (held - width) & ((1 << width) - 1)
            held -= width
            bits &= (1 << held) - 1
            if code == 257:
                return b"".join(out)
            if code == 256:
                del table[258:]
                width, previous = 9, b""
                continue
            entry = table[code] if code < len(table) else previous + previous[:1]
            out.append(entry)
            if previous:
                table.append(previous + entry[:1])
            previous = entry
            size = len(table) + 1
            width = 12 if size >= 2048 else 11 if size >= 1024 else 10 if size >= 512 else 9
    return b"".join(out)


class Tiff:
    """The first image of an open file."""

    def __init__(self, file):
        self.file = file
        head = file.read(16)
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2])
        magic = struct.unpack(f"{self.order}H", head[2:4])[0] if self.order else 0
        if magic not in (42, 43):
            raise ValueError("not a TIFF file")
        self.big = magic == 43
        self.tags = self._tags(struct.unpack(f"{self.order}Q", head[8:16])[0] if self.big else struct.unpack(f"{self.order}I", head[4:8])[0])
        get = lambda tag, default=None: self.tags.get(tag, (default,))[0]
        self.width, self.height, self.bands = get(WIDTH), get(HEIGHT), get(SAMPLES, 1)
        if get(PREDICTOR, 1) != 1 or get(COMPRESSION, 1) not in (1, 5, 8, 32946):
            raise ValueError("the compression or predictor is not supported")
        self.compression, self.planar = get(COMPRESSION, 1), get(PLANAR, 1) == 2
        self.dtype = np.dtype(f"{self.order}{ {1: 'u', 2: 'i', 3: 'f'}[get(FORMAT, 1)] }{get(BITS, 8) // 8}")
        nodata = get(NODATA)
        self.nodata = float(nodata.split(b"\0")[0]) if nodata else None

    def _tags(self, at: int) -> dict:
        o, out = self.order, {}
        self.file.seek(at)
        n = struct.unpack(f"{o}{'Q' if self.big else 'H'}", self.file.read(8 if self.big else 2))[0]
        size, inline = (20, 8) if self.big else (12, 4)
        for entry in [self.file.read(size) for _ in range(n)]:
            tag, kind = struct.unpack(f"{o}HH", entry[:4])
            count = struct.unpack(f"{o}{'Q' if self.big else 'I'}", entry[4 : 12 if self.big else 8])[0]
            if kind not in _KINDS:
                continue
            form = f"{o}{count}{_KINDS[kind]}"
            raw = entry[-inline:]
            if struct.calcsize(form) > inline:
                self.file.seek(struct.unpack(f"{o}{'Q' if self.big else 'I'}", raw)[0])
                raw = self.file.read(struct.calcsize(form))
            out[tag] = struct.unpack(form, raw[: struct.calcsize(form)])
        return out

    def dates(self) -> list[datetime.date]:
        """A date for each band; an error if a description has none."""
        text = self.tags.get(METADATA, (b"",))[0].decode("utf-8", "replace")
        named = {int(k): v for k, v in re.findall(r'<Item name="DESCRIPTION" sample="(\d+)"[^>]*>([^<]*)</Item>', text)}
        out = []
        for band in range(self.bands):
            found = re.search(r"\d{4}-\d{2}-\d{2}", named.get(band, ""))
            if not found:
                raise ValueError(f"band {band} carries no date")
            out.append(datetime.date.fromisoformat(found[0]))
        return out

    def axes(self) -> tuple[list[float], list[float]]:
        """Latitudes and longitudes of the pixels' centres."""
        (sx, sy, *_), (i, j, _, x, y, *_) = self.tags[SCALE], self.tags[TIE]
        return [y - (r - j + 0.5) * sy for r in range(self.height)], [x + (c - i + 0.5) * sx for c in range(self.width)]

    def _block(self, k: int, shape: tuple[int, int, int]) -> np.ndarray:
        offsets, counts = (self.tags[TILES], self.tags[TILE_COUNTS]) if TILES in self.tags else (self.tags[STRIPS], self.tags[COUNTS])
        self.file.seek(offsets[k])
        raw = self.file.read(counts[k])
        raw = lzw_decode(raw) if self.compression == 5 else zlib.decompress(raw) if self.compression != 1 else raw
        return np.frombuffer(raw[: int(np.prod(shape)) * self.dtype.itemsize], self.dtype).reshape(shape)

    def tiles(self, first: int, last: int):
        """(top, values of bands by rows by columns) for each row of blocks, as doubles; no-data is NaN. A block that holds all
        bands is decoded once for the bands first to last."""
        tiled = TILES in self.tags
        bw, bh = (self.tags[TILE_W][0], self.tags[TILE_H][0]) if tiled else (self.width, min(self.height, self.tags.get(ROWS, (self.height,))[0]))
        across, down = -(-self.width // bw), -(-self.height // bh)
        for y in range(down):
            top, rows = y * bh, min(bh, self.height - y * bh)
            out = np.empty((last - first, rows, self.width))
            shape = (bh if tiled else rows, bw, 1 if self.planar else self.bands)
            for x in range(across):
                place = (slice(None), slice(None), slice(x * bw, (x + 1) * bw))
                wide = min(bw, self.width - x * bw)
                if self.planar:
                    for k in range(first, last):
                        out[k - first][place[1:]] = self._block(k * across * down + y * across + x, shape)[:rows, :wide, 0]
                else:
                    out[place] = np.moveaxis(self._block(y * across + x, shape)[:rows, :wide, first:last], 2, 0)
            yield top, out if self.nodata is None else np.where(out == self.nodata, np.nan, out)

    def band(self, number: int) -> np.ndarray:
        """A band as doubles, rows by columns; no-data is NaN."""
        return np.concatenate([x[0] for _, x in self.tiles(number, number + 1)])


@dataclass
class _Window(InputPartition):
    path: str
    first: int
    last: int


class GeoTiffSource(DataSource):
    """Options: path (a file or folder) or paths (separated by commas), on storage that all executors mount; window (bands of a task). A row is a date's part of
    a row of blocks, so that no row holds a whole large band. Options of writes: `write.TiffWriter`."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "date date, lats array<double>, lons array<double>, values array<double>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(listed(self.options, ".tif", ".tiff"), int(self.options.get("window", WINDOW)))

    def writer(self, schema: T.StructType, overwrite: bool):
        return TiffWriter(self.options, schema, overwrite)


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], window: int):
        self.paths, self.window = paths, window

    def partitions(self):
        out = []
        for path in self.paths:
            with open(path, "rb") as f:
                n = Tiff(f).bands
            out += [_Window(path, k, min(n, k + self.window)) for k in range(0, n, self.window)]
        return out or [_Window("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        with open(partition.path, "rb") as f:
            image = Tiff(f)
            dates, (lats, lons) = image.dates(), image.axes()
            for top, values in image.tiles(partition.first, partition.last):
                for day, band in zip(dates[partition.first : partition.last], values, strict=True):
                    yield _batch(day, lats[top : top + len(band)], lons, band)


def _batch(day: datetime.date, lats: list[float], lons: list[float], band: np.ndarray) -> pa.RecordBatch:
    """A tile as one row of Arrow lists, without boxed numbers."""
    listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array([day], pa.date32()), listed(lats), listed(lons), listed(band.ravel())], ["date", "lats", "lons", "values"])
