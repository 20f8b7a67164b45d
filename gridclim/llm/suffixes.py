"""Exact removal of repeated byte strings by suffix sorting with bucket-pointer refinement.

1. Every window of LENGTH bytes has an anchor: the Q bytes in it with the least hash, the rightmost of equals. Equal windows
   have equal anchors in equal places, so only anchors whose initial bucket - the same Q bytes - holds another
   anchor can be in a repeated window. A run of windows with one anchor is a row, with a digest of all its bytes.
2. Runs whose whole bytes stand elsewhere too are repeated as they are; one of each sort goes on as a pattern.
3. The other runs of shared buckets go on with their bytes. Runs of one bucket meet in a task, which sorts their
   suffixes: initial buckets of 8 bytes, and only those that still hold several suffixes, are refined in place by the bucket
   pointers of the suffixes as many bytes on as the bucket is known to share. New pointers, and what their buckets share, stand at
   once for the buckets that are refined after, the bucket's own parts among them, so that depths add up instead of growing by 8.
   Neighbours in this order that share LENGTH bytes are repeated.
   Buckets of very many runs are first cut by longer q-grams: windows that begin in the farther and the nearer half of the
   places before the anchor share more bytes than the anchor, so the halves are buckets by these bytes, halved again as
   long as a bucket is too large. No task holds such a bucket, and equal windows always stay together.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Scratch, byte_values, column_bytes, joined, map_arrow, prefix_hash, read_table, release, row_key, slices, span_hash, spread

LENGTH, Q = 400, 64
#: Bytes of an initial bucket, and suffixes of buckets that are refined before their pointers are used.
GRAM, REFINED = 8, 1 << 14
#: Runs of a bucket beyond which it is cut by longer q-grams, so that no task sorts more than some 400 KB of it at a time; and
#: bytes of smaller buckets that a task sorts together.
CROWDED, SORTED_BYTES = 500, 1 << 20
_BYTES = byte_values(41)
_PIECE, _TOGETHER, _PLACE = 1 << 22, 1 << 15, U64((1 << 23) - 1)


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    n = len(h)
    padded = np.full(-(-n // width) * width, U64(2**64 - 1))
    padded[:n] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor value: the text's number, that value, the anchor's place, first window and end of the
    last window, places counted in all of data. data are the bytes of texts end to end, which begin and end at the bounds; no
    window crosses one. Short texts go some together; a text of over _PIECE bytes goes in pieces, whose windows do not overlap."""
    parts, text = [(np.zeros(0, np.int64), np.zeros(0, U64), *[np.zeros(0, np.int64)] * 3)], 0
    while text < len(bounds) - 1:
        after = max(text + 1, int(np.searchsorted(bounds, bounds[text] + _TOGETHER, "right")) - 1)
        low = bounds[text]
        number, value, *places = _runs(data[low : bounds[after]], bounds[text : after + 1] - low, length, q)
        parts.append((number + text, value, *[x + low for x in places]))
        text = after
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(whole: np.ndarray, bounds: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    parts = [(np.zeros(0, np.int64), np.zeros(0, U64), *[np.zeros(0, np.int64)] * 3)]
    fits = np.diff(bounds) >= length
    opens, closes = bounds[:-1][fits], bounds[1:][fits] - length + 1
    for at in range(0, max(0, len(whole) - length + 1), _PIECE):
        data = whole[at : at + _PIECE + length - 1]
        prefix = prefix_hash(_BYTES[data])
        start = np.arange(len(data) - q + 1)
        h = span_hash(prefix, start, start + q)
        # the low bits hold the place from the right, so that values are distinct and the rightmost of equals is least
        least = _sliding_least(h & ~_PLACE | (_PLACE - start.astype(U64)), length - q + 1)
        inside = np.zeros(len(least) + 1, np.int8)
        inside[opens[(opens > at) & (opens < at + len(least))] - at] += 1
        inside[closes[(closes > at) & (closes < at + len(least))] - at] -= 1
        inside[0] += np.searchsorted(opens, at, "right") - np.searchsorted(closes, at, "right")
        kept = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
        if not len(kept):
            continue
        new = np.ones(len(kept), bool)
        new[1:] = (least[kept[1:]] != least[kept[:-1]]) | (kept[1:] != kept[:-1] + 1)
        first, last = kept[new], kept[np.append(np.flatnonzero(new)[1:], len(kept)) - 1]
        anchor = (_PLACE - (least[first] & _PLACE)).astype(np.int64)
        parts.append((np.searchsorted(bounds, first + at, "right") - 1, h[anchor], anchor + at, first + at, last + at + length))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def grams(data: np.ndarray) -> np.ndarray:
    """For each position its GRAM bytes as a number that sorts like them; bytes past the end count as zeros."""
    n = len(data)
    wide, out = np.zeros(n + GRAM, U64), np.zeros(n, U64)
    wide[:n] = data
    for j in range(GRAM):
        out = out << U64(8) | wide[j : n + j]
    return out


def _portions(start: np.ndarray, size: np.ndarray):
    """Buckets in portions of about REFINED suffixes."""
    portion = (np.cumsum(size) - 1) // REFINED
    cuts = np.flatnonzero(np.diff(portion)) + 1
    yield from zip(np.split(start, cuts), np.split(size, cuts), strict=True)


def refined_buckets(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, pointer): the positions of data in the order of their suffixes, as far as buckets of one pointer, whose suffixes
    share `length` bytes (GRAM, if more); pointer[p] is where p's bucket begins in the order.

    A suffix ends with zeros up to a multiple of GRAM and then sorts before all that go on. `shared` holds what the suffixes of a
    bucket are known to share; a bucket is sorted by the pointers that many bytes on, and its parts share that and
    what the buckets pointed to share.
    """
    n = len(data)
    first = grams(data)
    order = np.argsort(first, kind="stable")
    start = np.flatnonzero(np.concatenate(([True], np.diff(first[order]) != 0))[:n])
    size = np.diff(np.append(start, n))
    pointer, shared = np.full(n + 1, -1), np.full(n + 1, GRAM)
    pointer[order] = np.repeat(start, size)
    shared[-1] = max(length, GRAM)  # past the end
    going = size > 1 if length > GRAM else np.zeros(len(size), bool)
    while going.any():
        parts = []
        for begin, many in _portions(start[going], size[going]):
            slot = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
            held, known = order[slot], np.repeat(shared[begin], many)
            later = pointer[np.minimum(held + known, n)]
            key = np.repeat(np.arange(len(begin)), many) * (n + 1) + later + 1
            by = np.argsort(key, kind="stable")
            held, key = held[by], key[by]
            new = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0)))
            reach = known[new] + shared[later[by][new]]
            own, count = slot[new], np.diff(np.append(new, len(key)))
            order[slot], pointer[held], shared[own] = held, np.repeat(own, count), reach
            parts.append((own, count, (count > 1) & (reach < length)))
        start, size, going = (np.concatenate(x) for x in zip(*parts, strict=True))
    return order, pointer[:n]


def repeated_windows(pieces: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece which of its windows of `length` bytes stand somewhere else in the pieces too."""
    sizes = [len(p) for p in pieces]
    data, starts = np.concatenate(pieces), np.cumsum([0, *sizes])
    order, pointer = refined_buckets(data, length)
    window = np.zeros(len(data), bool)
    for a, n in zip(starts, sizes, strict=False):
        window[a : a + max(0, n - length + 1)] = True
    order = order[window[order]]
    # neighbours of one bucket share enough; those of two may too, as pointers may part suffixes beyond `length`
    alike = np.diff(pointer[order]) == 0 if length >= GRAM else np.zeros(max(0, len(order) - 1), bool)
    left, gram = np.flatnonzero(~alike), grams(data)
    for k in [*range(0, length - GRAM, GRAM), max(0, length - GRAM)]:
        beyond = U64(8 * max(0, GRAM - length))
        left = left[gram[order[left] + k] >> beyond == gram[order[left + 1] + k] >> beyond]
    alike[left] = True
    found = np.zeros(len(data), bool)
    found[order[:-1][alike]] = found[order[1:][alike]] = True
    return [found[a : a + max(0, n - length + 1)] for a, n in zip(starts, sizes, strict=False)]


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as spans that neither overlap nor touch, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > reach[:-1])) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return start[first], reach[np.concatenate((first[1:], [len(start)])) - 1] if len(first) else reach


def _window_spans(found: np.ndarray, first: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the true windows, of which the first starts at `first`."""
    edge = np.diff(np.concatenate(([0], found.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1) + first, np.flatnonzero(edge == -1) - 1 + first + length


_RUNS = "h long, g int, bucket long, anchor int, first int, end int, k1 long, k2 long"
_PIECES = "bucket binary, low int, high int, anchor int, h long, g int, first int, done boolean, bytes binary"
_SPANS = "h long, g int, start int, end int"


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def digest(data: bytes, person: bytes = b"") -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=person).digest()


def _rows(columns: dict, schema: str) -> pa.RecordBatch:
    fields = [(name, _ARROW[kind]) for name, kind in (x.split() for x in schema.split(","))]
    put = lambda x, kind: x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind)
    return pa.RecordBatch.from_arrays([put(columns[name], kind) for name, kind in fields], [name for name, _ in fields])


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, q: int = Q) -> DataFrame:
    """(h, g, starts, ends): the spans of each row that has any, by its key (`common.row_key`)."""
    s = Scratch(df.sparkSession, "suffixes")
    keyed = df.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))

    def find(batches):
        release()
        for batch in slices(batches, 2000):
            raw, bounds = joined(batch.column(2))
            data = np.frombuffer(raw, np.uint8)
            text, bucket, anchor, first, end = runs(data, bounds, length, q)
            if len(text):
                whole = b"".join(digest(data[a:b].tobytes()) for a, b in zip(first.tolist(), end.tolist(), strict=True))
                keys, begin = np.frombuffer(whole, np.int64).reshape(-1, 2), bounds[text]
                own = [batch.column(k).to_numpy()[text] for k in (0, 1)]
                yield _rows(dict(zip(["h", "g", "bucket", "anchor", "first", "end", "k1", "k2"], [*own, bucket.view(np.int64), anchor - first, first - begin, end - begin, keys[:, 0], keys[:, 1]], strict=True)), _RUNS)

    found = s.save(map_arrow(keyed, find, _RUNS), "runs")
    # the counts are written, so that Spark can split the joins on the largest buckets
    shared = s.save(found.groupBy("bucket").agg(F.count("*").alias("n_bucket")).where("n_bucket > 1").select("bucket"), "shared-buckets")
    inside = s.save(found.join(shared, "bucket"), "shared")
    s.drop("runs", "shared-buckets")
    alike = s.save(inside.groupBy("k1", "k2").agg(F.count("*").alias("n_alike"), F.min(F.struct("h", "g", "first")).alias("one")).where("n_alike > 1"), "alike")
    judged = s.save(inside.join(alike, ["k1", "k2"], "left").withColumn("one", F.col("one") == F.struct("h", "g", "first")).drop("k1", "k2"), "judged")
    s.drop("shared", "alike")
    whole = judged.where("n_alike is not null").select("h", "g", F.col("first").alias("start"), "end")
    going = judged.where("n_alike is null or one")
    buckets = s.save(going.groupBy("bucket").agg(F.count_if(F.col("n_alike").isNull()).alias("n_open"), F.count("*").alias("n")).where("n_open > 0").select("bucket", (F.col("n") > CROWDED).alias("crowded")), "buckets")
    run_of = F.struct("bucket", "anchor", "first", "end", F.coalesce("one", F.lit(False)).alias("done"), "crowded")
    by_doc = going.join(buckets, "bucket").groupBy("h", "g").agg(F.collect_list(run_of).alias("runs"))
    names = ["bucket", "low", "high", "anchor", "h", "g", "first", "done", "bytes", "crowded"]

    def cut(batches):
        for batch in slices(batches):
            own = batch.column(2)
            r = {f.name: own.flatten().field(f.name) for f in own.type.value_type}
            row = np.repeat(np.arange(len(own)), np.diff(np.asarray(own.offsets)))
            data = list(column_bytes(batch.column(3)))
            pieces = [data[k][x:y] for k, x, y in zip(row.tolist(), np.asarray(r["first"]).tolist(), np.asarray(r["end"]).tolist(), strict=True)]
            key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(row), [None, pa.py_buffer(np.asarray(r["bucket"]).tobytes())]).cast(pa.binary())
            keys = [batch.column(k).take(pa.array(row)) for k in (0, 1)]
            yield _rows(dict(zip(names, [key, np.zeros(len(row), np.int32), np.full(len(row), length - q, np.int32), r["anchor"], *keys, r["first"], r["done"], pieces, r["crowded"]], strict=True)), _PIECES + ", crowded boolean")

    # one of several equal rows of a document stands for all: they are alike, hence whole, and at most a pattern
    texts = by_doc.join(keyed.where(F.length("text") > 0), ["h", "g"]).select("h", "g", "runs", "text")
    pieces = s.save(map_arrow(texts, cut, _PIECES + ", crowded boolean"), "pieces")
    ready, single = [pieces.where("not crowded").drop("crowded")], []
    crowded, level = pieces.where("crowded").drop("crowded"), 0
    while crowded.limit(1).count():
        level += 1
        halves = s.save(map_arrow(crowded, _halves(length), _PIECES), f"halves-{level}")
        counts = s.save(halves.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), f"counts-{level}")
        halves = halves.join(counts, "bucket")
        single.append(halves.where("low = high and not done").select("h", "g", F.col("first").alias("start"), (F.col("first") + length).alias("end")))
        ready.append(halves.where(f"low < high and n <= {CROWDED}").select(*names[:-1]))
        crowded = halves.where(f"low < high and n > {CROWDED}").select(*names[:-1])

    def refine(batches):
        for h_of, g_of, first, done, data in _by_bucket(batches):
            out = {k: [] for k in ("h", "g", "start", "end")}
            found = repeated_windows([np.frombuffer(x, np.uint8) for x in data], length)
            for h, g, f, known, windows in zip(h_of, g_of, first, done, found, strict=True):
                if not known and windows.any():
                    start, end = (x.tolist() for x in _window_spans(windows, f, length))
                    for k, x in zip(out, ([h] * len(start), [g] * len(start), start, end), strict=True):
                        out[k] += x
            yield _rows(out, _SPANS)

    dealt = reduce(DataFrame.unionAll, ready).select("bucket", "h", "g", "first", "done", "bytes").repartition("bucket").sortWithinPartitions("bucket", "h", "g", "first")
    spans = reduce(DataFrame.unionAll, [whole, dealt.mapInArrow(refine, _SPANS), *single])

    def unite(batches):
        for batch in slices(batches, 2000):
            own, n = batch.column(2), batch.num_rows
            row = np.repeat(np.arange(n), np.diff(np.asarray(own.offsets)))
            start, end = (np.asarray(own.flatten().field(k).cast(pa.int64())) + (row << 32) for k in ("start", "end"))
            a, b = merged(start, end)
            offsets = pa.array(np.searchsorted(a >> 32, np.arange(n + 1)), pa.int32())
            spots = [pa.ListArray.from_arrays(offsets, pa.array(x & 0xFFFFFFFF, pa.int64())) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *spots], ["h", "g", "starts", "ends"])

    return s.save(map_arrow(spans.groupBy("h", "g").agg(F.collect_list(F.struct("start", "end"))), unite, "h long, g int, starts array<long>, ends array<long>"), "spans")


def _halves(length: int):
    """Cuts pieces whose windows begin `low` to `high` bytes before the anchor into those of either half, bucketed by the
    bytes that all windows of a half cover."""

    def run(batches):
        for batch in slices(batches, 1000):
            out = {x.split()[0]: [] for x in _PIECES.split(",")}
            rows = [batch.column(k).to_pylist() for k in ("low", "high", "anchor", "h", "g", "first", "done")]
            for low, high, anchor, h, g, first, done, data in zip(*rows, column_bytes(batch.column("bytes")), strict=True):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    begin, last = max(0, anchor - b), min(len(data) - length, anchor - a)
                    if begin <= last:
                        core = data[anchor - a : anchor - b + length]
                        for k, x in zip(out, (digest(core, b"%d-%d" % (a, b)), a, b, anchor - begin, h, g, first + begin, done, data[begin : last + length]), strict=True):
                            out[k].append(x)
            yield _rows(out, _PIECES)

    return run


def _by_bucket(batches, most: int = SORTED_BYTES):
    """Columns of whole buckets of about `most` bytes together, from rows sorted by bucket."""
    rows, size, last = [], 0, None
    for batch in slices(batches):
        for bucket, *row in zip(*(batch.column(k).to_pylist() for k in range(5)), column_bytes(batch.column(5)), strict=True):
            if rows and bucket != last and size >= most:
                yield map(list, zip(*rows, strict=True))
                rows, size = [], 0
            rows.append(row)
            size += len(row[-1])
            last = bucket
    if rows:
        yield map(list, zip(*rows, strict=True))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, n_bytes, starts, ends (the removed spans) and kept (the remaining bytes) of each input row.

    A byte is removed if a string of `length` bytes that covers it also starts anywhere else, in the same document
    (overlaps count) or another; strings never cross documents. Nulls (empty) and texts shorter than `length` stay as
    they are; texts of any length go through whole. Equal rows, null ids included, are documents that repeat each
    other; ids are of any type. Every occurrence goes, so there are no ties; an empty table gives no rows, and other
    columns do not matter.
    """
    spans = repeats(df, id_col, text_col, length)
    keyed = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *row_key(id_col, text_col))
    rows = keyed.join(spans, ["h", "g"], "left").select("id", "text", "starts", "ends")

    def run(batches):
        for batch in slices(batches):
            size, kept = [], []
            for text, starts, ends in zip(column_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                size.append(len(text))
                at, parts = 0, []
                for a, b in zip(starts or (), ends or (), strict=True):
                    parts.append(text[at:a])
                    at = b
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), batch.column(2), batch.column(3), pa.array(kept, pa.binary())], [id_col, "n_bytes", "starts", "ends", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(rows, run, f"{id_col} {kind}, n_bytes long, starts array<long>, ends array<long>, kept binary")


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`remove_repeats` of all documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = remove_repeats(spread(read_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
