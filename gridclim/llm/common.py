"""Shared pieces: the scratch folder, Arrow helpers, and vectorised word and q-gram hashing.

Every operator projects the columns it names and ignores the rest, so extra columns of any name
can neither clash with nor leak into its result.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
_POW = {_BASE: np.ones(1, U64), _INV: np.ones(1, U64)}


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies (or was shipped) beside the driver's."""
    here, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH")) if x)


def small_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Bounds the Arrow batches that go to Python workers. For jobs of many stages in one session, whose executors hold
    off-heap what a batch needs on top of a heap that earlier stages have filled."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


@contextmanager
def batches_of(spark: SparkSession, rows: int = 2000, size: str = "8m") -> Iterator[None]:
    """Bounds the Arrow batches of the jobs that run inside, and then restores the session's own settings."""
    importable(spark)
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str, text_col: str) -> list:
    """h and g: 96 bits by which a row is found again, whatever the type of its id; equal for rows of one id and text."""
    return [F.xxhash64(id_col, text_col).alias("h"), F.hash(text_col, id_col).alias("g")]


def spread(df: DataFrame) -> DataFrame:
    """A table just read, in partitions enough for all cores: a small one in a single file is dealt out, larger ones are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Bytes of a row group that a worker writes.
GROUP_BYTES = 16 << 20


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow(run, schema), of which `Scratch.save` can write the batches where they arise."""
    out = df.mapInArrow(run, schema)
    out._mapped = (df, run)
    return out


def _write_part(batches, folder: str, schema: pa.Schema) -> int:
    """Writes a task's batches as one Parquet file of the folder, whole or not at all; the first attempt that ends counts."""
    import pyarrow.parquet as pq
    from pyspark import TaskContext

    name = f"part-{TaskContext.get().partitionId():06d}.parquet"
    beside, writer, rows, held, size = f"{folder}/.{name}.{uuid.uuid4().hex}", None, 0, [], 0

    def flush() -> None:
        nonlocal writer, held, size
        writer = writer or pq.ParquetWriter(beside, schema)
        table = pa.Table.from_batches(held).select(schema.names).cast(schema)
        writer.write_table(table, row_group_size=max(1, table.num_rows))
        held, size = [], 0

    try:
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
                if size >= GROUP_BYTES:
                    flush()
        if held:
            flush()
        if writer:
            writer.close()
            try:
                os.link(beside, f"{folder}/{name}")
            except FileExistsError:
                pass
            except OSError:  # a folder without links: the last attempt counts
                os.replace(beside, f"{folder}/{name}")
    finally:
        if os.path.exists(beside):
            os.unlink(beside)
    return rows


class Scratch:
    """Intermediate tables in the folder that all executors share (spark.checkpoint.dir).

    A table read back has no lineage, so a lost executor costs one read and not a recomputation.
    Where the setting is absent (tests), a folder under the warehouse is used.

    In a mounted folder the workers write the files themselves: there Spark's writer starts a process for every file it
    makes, to set its mode, which for a moment doubles what is counted as the executor's memory. On other stores Spark writes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        mounted = re.match(r"^(?:file:/*(?=/)|(?=/))", self.root)
        self.mounted = self.root[mounted.end() :] if mounted else None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The table, written and read back."""
        if self.mounted is None:
            df.write.parquet(self.path(name))
        else:
            folder, schema = f"{self.mounted}/{name}", to_arrow_schema(df.schema)
            os.makedirs(folder)
            source, run = getattr(df, "_mapped", (df, lambda batches: batches))

            def write(batches):
                yield pa.RecordBatch.from_arrays([pa.array([_write_part(run(batches), folder, schema)], pa.int64())], ["rows"])

            source.mapInArrow(write, "rows long").collect()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Frees tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def column_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string or binary Arrow column, null as empty, without decoding to str."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


_KEPT: dict[str, tuple] = {}


def kept(name: str, key, make):
    """A worker's object of a name, made anew when the key changes. A worker keeps one object at a time."""
    if name not in _KEPT or _KEPT[name][0] != key:
        release()
        _KEPT[name] = (key, make())
    return _KEPT[name][1]


def release() -> None:
    """Frees what an earlier operator left in this worker; steps that keep nothing begin with it."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def slices(batches, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that what a step builds from a part stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized(batches, column: int, size: int = 4 << 20, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows and, unless one text alone is longer, so many bytes of a column."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(at, end - at)
            at = end


def powers(base: int, n: int) -> np.ndarray:
    have = _POW[base]
    if len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U64)
        have[0] = 1
        _POW[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public murmur3 constants)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def byte_values(seed: int, lower: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; with lower, A-Z share those of a-z."""
    table = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=U64)
    if lower:
        table[65:91] = table[97:123]
    return table


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums P with P[i] = sum of values[j] * base**j over j < i, modulo 2**64, of 64-bit values."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes start..end, alike wherever the same bytes stand."""
    inverse = powers(_INV, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def _folded(separators: list[int]) -> bytes:
    """A table that lower-cases A-Z and turns separators into spaces."""
    table = bytearray(range(256))
    table[65:91] = table[97:123]
    for b in separators:
        table[b] = 0x20
    return bytes(table)


#: What parts words: ASCII white space, or all ASCII characters but digits and letters.
_FOLD = {"space": _folded([*range(0x09, 0x0E)]), "alnum": _folded([b for b in range(0x80) if not chr(b).isalnum()])}
_WORD_BYTE = np.frombuffer(_FOLD["space"], np.uint8) != 0x20
#: Bytes that are cut into words at a time, and bytes of the longest word that is hashed in lanes.
_BLOCK, _LONGEST = 1 << 22, 64


def word_list(text: bytes, kind: str) -> list[bytes]:
    """The words of a text in order, A-Z lower-cased."""
    return text.translate(_FOLD[kind]).split()


def plain_words(text: bytes, kind: str) -> Iterator[bytes]:
    """The words of a text, A-Z lower-cased, with a space after each; a long text in parts."""
    folded, at = text.translate(_FOLD[kind]), 0
    while at < len(folded):
        end = folded.find(b" ", at + _BLOCK)
        end = len(folded) if end < 0 else end
        if words := folded[at:end].split():
            yield b" ".join(words) + b" "
        at = end


def joined(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all texts end to end (null: empty), and where each begins and the last ends."""
    flat = column.cast(pa.large_binary())
    flat = flat.fill_null(b"") if flat.null_count else flat
    at = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    data = flat.buffers()[2]
    return (data.to_pybytes()[at[0] : at[-1]] if data else b""), at - at[0]


def word_hashes(texts: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the texts, A-Z lower-cased, and where each text's words begin and the last's end.

    Bytes go in blocks, cut between words, so a long text needs 8 bytes a word and little more.
    """
    data, bounds = joined(texts)
    folded = data.translate(_FOLD[kind])
    parts, first, at = [], np.zeros(len(bounds), np.int64), 0
    total = 0
    while at < len(folded):
        end = folded.find(b" ", at + _BLOCK)
        end = len(folded) if end < 0 else end
        k = np.searchsorted(bounds, at + _BLOCK)
        end = min(end, int(bounds[k])) if k < len(bounds) else end
        low, high = np.searchsorted(bounds, (at, end))
        hashes, starts = _hashes(folded[at:end], bounds[low : high + (end == len(folded))] - at)
        inside = slice(low, np.searchsorted(bounds, end, "right"))
        first[inside] = total + np.searchsorted(starts, bounds[inside] - at)
        parts.append(hashes)
        total += len(hashes)
        at = end
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, U64), first


def _hashes(folded: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words between spaces; words end at the bounds too. Each 8 bytes pass the finaliser, longer words BLAKE2."""
    n = len(folded)
    data = np.frombuffer(folded, np.uint8)
    inside = data != 0x20
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    begins[bounds[bounds < n]] = inside[bounds[bounds < n]]
    last = bounds[(bounds > 0) & (bounds <= n)] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = end - start
    lanes = np.ndarray((n + 1,), "<u8", folded + bytes(8), strides=(1,))
    out = mix(size.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1))
    open_ = np.flatnonzero(size <= _LONGEST)
    at, left = start[open_], size[open_]
    while len(open_):
        lane = lanes[at] & _LANE[np.minimum(left, 8)]
        out[open_] = mix((out[open_] ^ lane) * U64(0xD6E8FEB86659FD93) + U64(0x2545F4914F6CDD1D))
        going = left > 8
        open_, at, left = open_[going], at[going] + 8, left[going] - 8
    for k in np.flatnonzero(size > _LONGEST).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(folded[start[k] : end[k]], digest_size=8).digest(), "little")
    return out, start


_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` word hashes; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.full(n, size, U64)
    for j in range(size):
        total = total * U64(0x2545F4914F6CDD1D | 1) + hashes[j : j + n]
        total ^= total >> U64(29)
    return mix(total)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; the whole sequence as one if it is shorter; empty without words."""
    return np.unique(windows(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def count_words(text: bytes) -> int:
    """Words between ASCII white space."""
    total, before = 0, False
    for at in range(0, len(text), _BLOCK):
        inside = _WORD_BYTE[np.frombuffer(text[at : at + _BLOCK], np.uint8)]
        total += int(np.count_nonzero(inside[1:] & ~inside[:-1])) + bool(inside[0] and not before)
        before = inside[-1]
    return total
