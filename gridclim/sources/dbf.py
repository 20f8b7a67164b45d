"""dBase III tables as a Spark data source, read by ranges of records, plain or inside a zip, and written as folders of files.

spark.dataSource.register(DbfSource); spark.read.format("dbf").option("path", ...).option("columns", "A,B").load()
df.write.format("dbf").mode("append").option("width", "NAME=25").save(folder)
"""

from __future__ import annotations

import datetime
import struct
import zipfile
from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridclim.sources.files import listed
from gridclim.sources.write import DbfWriter

#: Records read by one task.
RECORDS = 200_000


@dataclass
class Field:
    name: str
    kind: str
    offset: int
    width: int
    places: int


@dataclass
class Header:
    records: int
    start: int
    width: int
    fields: list[Field]


def read_header(data) -> Header:
    """Header of an open binary file: the number of records, where they start, their width and fields."""
    first = data.read(32)
    records, start, width = struct.unpack("<IHH", first[4:12])
    fields, offset = [], 1
    while (mark := data.read(1)) not in (b"\r", b""):
        raw = mark + data.read(31)
        name, kind = raw[:11].split(b"\0")[0].decode("ascii"), chr(raw[11])
        if kind not in "CNFDL":
            raise ValueError(f"field {name} has the unsupported type {kind}")
        fields.append(Field(name, kind, offset, raw[16], raw[17]))
        offset += raw[16]
    return Header(records, start, width, fields)


def _type(f: Field) -> T.DataType:
    return {"C": T.StringType(), "D": T.DateType(), "L": T.BooleanType()}.get(f.kind) or (T.DoubleType() if f.kind == "F" or f.places else T.LongType())


def decode(f: Field, raw: bytes):
    """A field's value; blank numbers, dates and flags are null."""
    text = raw.decode("latin-1").strip()
    if f.kind == "C":
        return text
    if not text or set(text) == {"*"}:
        return None
    if f.kind == "D":
        return datetime.datetime.strptime(text, "%Y%m%d").date()
    if f.kind == "L":
        return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
    return float(text) if isinstance(_type(f), T.DoubleType) else int(text)


def _open(path: str):
    if not path.lower().endswith(".zip"):
        return open(path, "rb")
    archive = zipfile.ZipFile(path)
    return archive.open(next(n for n in archive.namelist() if n.lower().endswith(".dbf")))


@dataclass
class _Range(InputPartition):
    path: str
    first: int
    last: int


class DbfSource(DataSource):
    """Options: path (a file or folder) or paths (with commas between), on storage that all executors mount; columns (a list with commas;
    default all); records (of a task). Files of one read have the wanted columns in common, by name and type. Options of
    writes: `write.DbfWriter`."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def _files(self) -> list[str]:
        return listed(self.options, ".dbf", ".zip")

    def schema(self) -> T.StructType:
        files = self._files()
        if not files:
            raise ValueError("no files: name the columns by a schema")
        return T.StructType([T.StructField(f.name, _type(f)) for f in _wanted(files[0], self.options)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self._files(), dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool):
        return DbfWriter(self.options, schema, overwrite)


def _wanted(path: str, options) -> list[Field]:
    with _open(path) as data:
        header = read_header(data)
    wanted = [c for c in options.get("columns", "").split(",") if c]
    by_name = {f.name: f for f in header.fields}
    if missing := [c for c in wanted if c not in by_name]:
        raise ValueError(f"no such columns: {missing}")
    return [by_name[c] for c in wanted] if wanted else header.fields


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], options: dict, schema: T.StructType):
        self.paths, self.options, self.schema = paths, options, schema

    def partitions(self):
        out, size = [], int(self.options.get("records", RECORDS))
        for path in self.paths:
            with _open(path) as data:
                n = read_header(data).records
            out += [_Range(path, k, min(n, k + size)) for k in range(0, n, size)]
        return out or [_Range("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        fields = _wanted(partition.path, self.options)
        if [(f.name, _type(f)) for f in fields] != [(f.name, f.dataType) for f in self.schema]:
            raise ValueError(f"{partition.path} has other columns")
        with _open(partition.path) as data:
            header = read_header(data)
            data.seek(header.start + partition.first * header.width)
            for _ in range(partition.first, partition.last):
                record = data.read(header.width)
                if len(record) < header.width:
                    break
                if record[:1] != b"*":
                    yield tuple(decode(f, record[f.offset : f.offset + f.width]) for f in fields)
