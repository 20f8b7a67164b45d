"""Files of the formats that the sources read: dBase III, GeoTIFF and classic netCDF, and how the tasks of a job write folders of them."""

from __future__ import annotations

import datetime
import struct
from collections.abc import Iterable
from itertools import chain, islice

import numpy as np
from pyspark.sql import types as T

from gridclim.sources.files import FolderWriter

#: Records of a dBase file, and bands or time steps of a raster file.
RECORDS, BANDS = 2_000_000, 366
_TIFF_MISSING = -9999.0


def write_dbf(path: str, fields: list[tuple[str, str, int, int]], rows: Iterable[tuple]) -> None:
    """fields: name, type (C, N, F, D or L), width and decimal places; None is blank. F with no places is as long as it takes to
    be read back exactly. Rows are written as they come and their number last."""
    width = 1 + sum(f[2] for f in fields)
    head = lambda n: struct.pack("<BBBBIHH20x", 3, 124, 1, 1, n, 33 + 32 * len(fields), width)
    described = b"".join(struct.pack("<11sc4xBB14x", name.encode("ascii"), kind.encode("ascii"), w, places) for name, kind, w, places in fields) + b"\r"

    def text(value, kind: str, w: int, places: int) -> bytes:
        if value is None:
            out = ""
        elif kind == "D":
            out = value.strftime("%Y%m%d")
        elif kind == "L":
            out = "T" if value else "F"
        elif kind == "C" or kind == "N" and isinstance(value, int) and not places:
            out = str(value)  # whole numbers as they are, since floats have no room for the largest
        elif kind == "F" and not places:
            out = repr(float(value))
        else:
            out = f"{value:.{places}f}"
        if len(out) > w:
            raise ValueError(f"{out!r} is wider than {w}")
        return (out.ljust(w) if kind == "C" else out.rjust(w)).encode("latin-1")

    with open(path, "wb") as f:
        n = 0
        f.write(head(n) + described)
        for n, row in enumerate(rows, 1):
            f.write(b" " + b"".join(text(v, kind, w, places) for v, (_, kind, w, places) in zip(row, fields, strict=True)))
        f.seek(0)
        f.write(head(n))


def write_tiff(path: str, bands: np.ndarray, north: float, west: float, step: float, dates: list[datetime.date], missing: float = _TIFF_MISSING) -> None:
    """Bands of 32-bit numbers, one a date, uncompressed; north and west are the centre of the first pixel."""
    bands = np.where(np.isnan(bands), missing, bands).astype("<f4")
    n, height, width = bands.shape
    names = "<GDALMetadata>" + "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{k}_{d.isoformat()}</Item>' for k, d in enumerate(dates)) + "</GDALMetadata>"
    data, size = bands.tobytes(), 4 * height * width
    tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [32] * n), (259, 3, [1]), (273, 4, [8 + k * size for k in range(n)]), (277, 3, [n]), (278, 4, [height]), (279, 4, [size] * n), (284, 3, [2]), (339, 3, [3] * n)]
    tags += [(33550, 12, [step, step, 0.0]), (33922, 12, [0.0, 0.0, 0.0, west - step / 2, north + step / 2, 0.0]), (42112, 2, names.encode() + b"\0"), (42113, 2, f"{missing:g}".encode() + b"\0")]
    at, entries, extra = 8 + len(data), b"", b""
    beyond = at + 2 + 12 * len(tags) + 4
    for tag, kind, value in tags:
        raw = value if kind == 2 else struct.pack(f"<{len(value)}{ {3: 'H', 4: 'I', 12: 'd'}[kind] }", *value)
        entries += struct.pack("<HHI", tag, kind, len(value)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", beyond + len(extra)))
        extra += raw if len(raw) > 4 else b""
    with open(path, "wb") as f:
        f.write(b"II" + struct.pack("<HI", 42, at) + data + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra)


def write_netcdf(path: str, name: str, field: np.ndarray, lats: list[float], lons: list[float], dates: list[datetime.date]) -> None:
    """A field (time, latitude, longitude) of 64-bit numbers; time grows."""
    label = lambda s: struct.pack(">i", len(s)) + s.encode().ljust(-(-len(s) // 4) * 4, b"\0")
    some = lambda tag, items: struct.pack(">ii", tag if items else 0, len(items)) + b"".join(items)
    dims = [label("time") + struct.pack(">i", 0), label("latitude") + struct.pack(">i", len(lats)), label("longitude") + struct.pack(">i", len(lons))]
    units = f"hours since {dates[0].isoformat()} 00:00:00"
    about = [label("units") + struct.pack(">ii", 2, len(units)) + units.encode().ljust(-(-len(units) // 4) * 4, b"\0")]

    def head(begins: list[int]) -> bytes:
        put = lambda n, d, attributes, kind, size, begin: label(n) + struct.pack(f">i{len(d)}i", len(d), *d) + some(12, attributes) + struct.pack(">iii", kind, size, begin)
        variables = [put("latitude", [1], [], 6, 8 * len(lats), begins[0]), put("longitude", [2], [], 6, 8 * len(lons), begins[1]), put("time", [0], about, 4, 4, begins[2]), put(name, [0, 1, 2], [], 6, 8 * len(lats) * len(lons), begins[3])]
        return b"CDF\x01" + struct.pack(">i", len(dates)) + some(10, dims) + struct.pack(">ii", 0, 0) + some(11, variables)

    n = len(head([0] * 4))
    axes = n + 8 * (len(lats) + len(lons))
    with open(path, "wb") as f:
        f.write(head([n, n + 8 * len(lats), axes, axes + 4]) + struct.pack(f">{len(lats) + len(lons)}d", *lats, *lons))
        for day, step in zip(dates, field, strict=True):
            f.write(struct.pack(">i", (day - dates[0]).days * 24) + step.astype(">f8").tobytes())


class DbfWriter(FolderWriter):
    """Options: width (bytes of a text column, 254 at most and by default; name=width pairs with commas between for some columns),
    records (of a file). Whole numbers become N, decimals N with their places, doubles F in full, dates D and flags L. Names have ten bytes
    at most. A null text is read back as an empty one, and blanks at the ends of a text go: the format has no others. Texts
    wider than their column, or with characters outside Latin-1, are errors."""

    ending = ".dbf"

    def check(self) -> None:
        given = self.options.get("width", "254")
        one = int(given) if "=" not in given else 254
        of = {k.strip(): int(v) for k, v in (x.split("=") for x in given.split(","))} if "=" in given else {}
        self.fields = [self._field(f, of.get(f.name, one)) for f in self.schema]

    def _field(self, f: T.StructField, width: int) -> tuple[str, str, int, int]:
        if len(f.name.encode()) > 10 or not f.name.isascii():
            raise ValueError(f"{f.name} is no name of ten ASCII characters at most")
        kind = f.dataType
        if isinstance(kind, T.StringType):
            if not 1 <= width <= 254:
                raise ValueError(f"a text column has 1 to 254 bytes, not {width}")
            return f.name, "C", width, 0
        if isinstance(kind, T.DecimalType):
            return f.name, "N", kind.precision + 2, kind.scale
        sizes = {T.ByteType: ("N", 4), T.ShortType: ("N", 6), T.IntegerType: ("N", 11), T.LongType: ("N", 20), T.FloatType: ("F", 24), T.DoubleType: ("F", 24), T.DateType: ("D", 8), T.BooleanType: ("L", 1)}
        if type(kind) not in sizes:
            raise ValueError(f"a column of type {kind.simpleString()} has no place in the format")
        return f.name, *sizes[type(kind)], 0

    def put(self, rows, path):
        most = int(self.options.get("records", RECORDS))
        for first in rows:
            name = path()
            write_dbf(name, self.fields, chain([first], islice(rows, most - 1)))
            yield name


class RasterWriter(FolderWriter):
    """Tiles (date, lats, lons, values) as files of bands: neighbours in a task that have the same axes, `bands` of them at most, share
    one. Nulls and NaN are missing; a null date or axis, and values that do not fill the axes, are errors."""

    def check(self) -> None:
        if missing := {"date", "lats", "lons", "values"} - set(self.schema.names):
            raise ValueError(f"tiles need the columns {sorted(missing)}")

    def put(self, rows, path):
        most, axes, held, dates = int(self.options.get("bands", BANDS)), None, [], []
        for row in rows:
            if row.date is None or row.lats is None or row.lons is None or len(row["values"] or ()) != len(row.lats) * len(row.lons) or not row["values"]:
                raise ValueError(f"the tile of {row.date} has no date or axes, or values that do not fill them")
            own = (tuple(row.lats), tuple(row.lons))
            if held and (own != axes or len(held) >= most):
                yield self.file(path(), axes, np.stack(held), dates)
                held, dates = [], []
            axes = own
            held.append(np.array([np.nan if v is None else v for v in row["values"]], float).reshape(len(own[0]), len(own[1])))
            dates.append(row.date)
        if held:
            yield self.file(path(), axes, np.stack(held), dates)

    def file(self, path: str, axes: tuple, field: np.ndarray, dates: list) -> str:
        raise NotImplementedError


class TiffWriter(RasterWriter):
    """Values become 32-bit numbers. Axes go south and east in equal steps, the same for both; option step for a single pixel."""

    ending = ".tif"

    def file(self, path, axes, field, dates):
        lats, lons = axes
        steps = np.concatenate((-np.diff(lats), np.diff(lons)))
        step = float(self.options["step"]) if "step" in self.options else float(steps[0]) if len(steps) else 0.0
        if step <= 0 or not np.allclose(steps, step, rtol=0, atol=1e-9):
            raise ValueError("the axes do not go south and east in equal steps")
        if (field == _TIFF_MISSING).any():
            raise ValueError(f"{_TIFF_MISSING} stands for missing pixels")
        write_tiff(path, field, lats[0], lons[0], step, dates)
        return path


class NetcdfWriter(RasterWriter):
    """Values stay 64-bit numbers; option variable names them. Steps may be in any order of dates."""

    ending = ".nc"

    def file(self, path, axes, field, dates):
        write_netcdf(path, self.options.get("variable", "value"), field, list(axes[0]), list(axes[1]), dates)
        return path
