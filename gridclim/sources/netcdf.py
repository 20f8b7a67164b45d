"""Classic netCDF (CDF-1 and CDF-2) as a Spark data source: a row (date, lats, lons, values) for each time step.

The first variable over time, latitude and longitude is read; coordinates go by their usual names. Files of the
HDF5-based version need a library that is not at hand and raise.
"""

from __future__ import annotations

import datetime
import re
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridclim.sources.files import listed
from gridclim.sources.write import NetcdfWriter

# fixed values: the format's types, and names of coordinates
_TYPES = {1: "i1", 2: "S1", 3: "i2", 4: "i4", 5: "f4", 6: "f8"}
AXES = {"time": {"time", "valid_time", "date"}, "lat": {"lat", "latitude", "y"}, "lon": {"lon", "longitude", "x"}}
STEPS = 31


@dataclass
class Variable:
    dims: list[int]
    attributes: dict
    dtype: np.dtype
    begin: int


class Classic:
    """Header of an open file: dims (name, length), variables by name, the number of records and a record's size."""

    def __init__(self, file):
        self.file = file
        magic = file.read(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2):
            raise ValueError("not a classic netCDF file")
        self.wide = magic[3] == 2
        self.records = self._int()
        self.dims = self._list(lambda: (self._name(), self._int()))
        self.attributes = dict(self._list(self._attribute))
        self.variables = dict(self._list(self._variable))
        own = [v for v in self.variables.values() if v.dims and self.dims[v.dims[0]][1] == 0]
        self.record_size = sum(self._padded(self._step(v)) for v in own) if len(own) != 1 else self._step(own[0])

    def _int(self) -> int:
        return struct.unpack(">i", self.file.read(4))[0]

    def _name(self) -> str:
        n = self._int()
        return self.file.read(-(-n // 4) * 4)[:n].decode()

    def _list(self, item) -> list:
        _, n = self._int(), self._int()
        return [item() for _ in range(n)]

    def _values(self):
        kind, n = self._int(), self._int()
        dtype = np.dtype(f">{_TYPES[kind]}")
        raw = self.file.read(-(-n * dtype.itemsize // 4) * 4)[: n * dtype.itemsize]
        return raw.decode("utf-8", "replace") if kind == 2 else np.frombuffer(raw, dtype)

    def _attribute(self):
        return self._name(), self._values()

    def _variable(self):
        name = self._name()
        dims = [self._int() for _ in range(self._int())]
        attributes = dict(self._list(self._attribute))
        dtype = np.dtype(f">{_TYPES[self._int()]}")
        self._int()
        begin = struct.unpack(">q", self.file.read(8))[0] if self.wide else self._int()
        return name, Variable(dims, attributes, dtype, begin)

    def shape(self, v: Variable) -> list[int]:
        return [self.dims[d][1] or self.records for d in v.dims]

    def _step(self, v: Variable) -> int:
        return int(np.prod([self.dims[d][1] for d in v.dims[1:]], dtype=np.int64)) * v.dtype.itemsize

    @staticmethod
    def _padded(n: int) -> int:
        return -(-n // 4) * 4

    def step(self, v: Variable, k: int) -> np.ndarray:
        """Index k of the first dimension, scaled, with missing values as NaN."""
        record = self.dims[v.dims[0]][1] == 0
        self.file.seek(v.begin + k * (self.record_size if record else self._step(v)))
        data = np.frombuffer(self.file.read(self._step(v)), v.dtype).reshape(self.shape(v)[1:])
        out = data.astype(float)
        for missing in ("_FillValue", "missing_value"):
            if missing in v.attributes:
                out[data == v.attributes[missing][0]] = np.nan
        return out * float(v.attributes.get("scale_factor", [1.0])[0]) + float(v.attributes.get("add_offset", [0.0])[0])

    def whole(self, name: str) -> np.ndarray:
        v = self.variables[name]
        return np.array([self.step(v, k) for k in range(self.shape(v)[0])])

    def axis(self, kind: str) -> str:
        return next(n for n in self.variables if n.lower() in AXES[kind])

    def field(self) -> Variable:
        """The first variable with a time, a latitude and a longitude dimension."""
        for v in self.variables.values():
            names = [self.dims[d][0].lower() for d in v.dims]
            if len(names) == 3 and all(any(n in AXES[k] for n in names) for k in AXES):
                if [next(k for k in AXES if n in AXES[k]) for n in names] != ["time", "lat", "lon"]:
                    raise ValueError("dimensions must come as time, latitude, longitude")
                return v
        raise ValueError("no variable over time, latitude and longitude")

    def dates(self) -> list[datetime.date]:
        name = self.axis("time")
        unit, start = re.match(r"(\w+) since (\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{2}:\d{2}:\d{2})?)", self.variables[name].attributes["units"]).groups()
        seconds = {"day": 86400, "hour": 3600, "minute": 60, "second": 1}[unit.lower().rstrip("s")]
        at = datetime.datetime.fromisoformat(start)
        return [(at + datetime.timedelta(seconds=float(x) * seconds)).date() for x in self.whole(name)]


@dataclass
class _Steps(InputPartition):
    path: str
    first: int
    last: int


class NetcdfSource(DataSource):
    """Options: path (a file or folder) or paths (separated by commas), on storage that all executors mount; steps (of a task). Options of
    writes: `write.NetcdfWriter`."""

    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def schema(self) -> str:
        return "date date, lats array<double>, lons array<double>, values array<double>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(listed(self.options, ".nc"), int(self.options.get("steps", STEPS)))

    def writer(self, schema: T.StructType, overwrite: bool):
        return NetcdfWriter(self.options, schema, overwrite)


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], size: int):
        self.paths, self.size = paths, size

    def partitions(self):
        out = []
        for path in self.paths:
            with open(path, "rb") as f:
                c = Classic(f)
                n = c.shape(c.field())[0]
            out += [_Steps(path, k, min(n, k + self.size)) for k in range(0, n, self.size)]
        return out or [_Steps("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        with open(partition.path, "rb") as f:
            c = Classic(f)
            v, dates = c.field(), c.dates()
            lats, lons = c.whole(c.axis("lat")).tolist(), c.whole(c.axis("lon")).tolist()
            for k in range(partition.first, partition.last):
                yield dates[k], lats, lons, c.step(v, k).ravel().tolist()
