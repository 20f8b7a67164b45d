"""MinHash near-duplicates by SetSketch registers.

Register i of a set is 1 - log_b of the least of its elements' exponential variates, floored and truncated
to 16 bits. Registers of a union are the maxima of the parts' registers, and equal ones tell the Jaccard
similarity. Bands of registers give candidates; a joint likelihood over greater, smaller and equal registers,
with the known set sizes, drops those that cannot be similar enough; full sets confirm the rest.

Documents of the same words in order are one class throughout. Hashes of shingles only choose what is compared: sets
are confirmed word by word. Within a bucket, members first meet the bucket's least member; what then is in different
components of one bucket is compared in blocks, none left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Scratch, column_bytes, map_arrow, mix, plain_words, read_table, release, row_key, shingle_hashes, slices, spread, word_hashes
from .components import components, extended

#: At a similarity of 0.8 all 32 bands of 4 registers differ with a probability of 5e-8.
REGISTERS, ROWS, BASE, RATE = 128, 4, 1.001, 20.0
BANDS = REGISTERS // ROWS
_rng = np.random.default_rng(977)
_XOR = _rng.integers(0, 2**32, (REGISTERS, 1), dtype=np.uint32)
_ODD = _rng.integers(0, 2**32, (REGISTERS, 1), dtype=np.uint32) | np.uint32(1)
#: A pair is dropped when its likelihood at the threshold is under exp(-CUT) of its best: five standard errors.
CUT = 12.5
#: Nodes of a block of the last, exhaustive comparison.
BLOCK = 256


def registers(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; all 0 for the empty set."""
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    folded = (shingles ^ (shingles >> U64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for at in range(0, len(folded), 4096):
        np.minimum(least, ((folded[at : at + 4096] ^ _XOR) * _ODD).min(axis=1), out=least)
    variate = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    return mix(np.ascontiguousarray(sketch).view(U64) + np.arange(1, BANDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def log_likelihood(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Of similarities (along the last axis) given how many registers of a are greater and smaller than those of b."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    over, under = np.maximum(p(u - v * similarity), 1e-12), np.maximum(p(v - u * similarity), 1e-12)
    even = np.maximum(1 - over - under, 1e-12)
    greater, smaller = greater[:, None], smaller[:, None]
    return greater * np.log(over) + smaller * np.log(under) + (REGISTERS - greater - smaller) * np.log(even)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The most likely similarity of each pair of sketches, and whether the threshold is still likely enough."""
    greater, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    grid = np.linspace(0, 1, 101) * top[:, None]
    found = log_likelihood(greater, smaller, n_a, n_b, grid)
    best = found.argmax(axis=1)
    at = log_likelihood(greater, smaller, n_a, n_b, np.minimum(threshold, top)[:, None])[:, 0]
    rows = np.arange(len(best))
    below = grid[rows, best] < threshold
    return grid[rows, best], (top + 1e-9 >= threshold) & (~below | (found[rows, best] - at <= CUT))


_SKETCH = ["n_shingles", "k1", "k2", "sketch"]


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, h, g, n_shingles, a 128-bit digest of the words in order (null without words) and the registers of the shingle set."""

    def run(batches):
        release()
        for batch in slices(batches, 2000):
            hashes, first = word_hashes(batch.column(3), "space")
            out = {k: [] for k in _SKETCH}
            for text, a, b in zip(column_bytes(batch.column(3)), first[:-1].tolist(), first[1:].tolist(), strict=True):
                found = shingle_hashes(hashes[a:b], shingle)
                digest = hashlib.blake2b(digest_size=16)
                for part in plain_words(text, "space"):
                    digest.update(part)
                k1, k2 = np.frombuffer(digest.digest(), np.int64).tolist() if len(found) else (None, None)
                for k, x in zip(_SKETCH, (len(found), k1, k2, registers(found).tobytes() if len(found) else None), strict=True):
                    out[k].append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3]] + [pa.array(out[k], pa.binary() if k == "sketch" else pa.int64()) for k in _SKETCH], ["id", "h", "g", *_SKETCH])

    kind = df.schema[id_col].dataType
    fields = [T.StructField("id", kind), T.StructField("h", T.LongType()), T.StructField("g", T.IntegerType())] + [T.StructField(k, T.BinaryType() if k == "sketch" else T.LongType()) for k in _SKETCH]
    return map_arrow(df.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col)), run, T.StructType(fields))


def word_bodies(df: DataFrame) -> DataFrame:
    """node and its words, A-Z lower-cased, with a space after each. Input columns node, text."""

    def run(batches):
        for batch in batches:
            words = [b"".join(plain_words(text, "space")) for text in column_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], ["node", "words"])

    return map_arrow(df.select("node", "text"), run, "node long, words binary")


def numbered_shingles(bodies: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct numbers of each body's shingles: equal numbers for equal words only, by comparing the words themselves."""
    number: dict[bytes, int] = {}
    put = number.setdefault
    each = [np.array([put(w, len(number)) for w in body.split()], np.int64) for body in bodies]
    width = len(number) + 1
    rows = []
    for ids in each:
        n = min(size, len(ids))
        rows.append(np.stack([ids[j : len(ids) - n + 1 + j] + 1 for j in range(n)] + [np.zeros(len(ids) - n + 1, np.int64)] * (size - n)) if n else np.zeros((size, 0), np.int64))
    flat, ends = np.concatenate(rows, axis=1), np.cumsum([r.shape[1] for r in rows])[:-1]
    key, most = np.zeros(flat.shape[1], np.int64), 1
    for column in flat:
        if most * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            most = int(key.max(initial=0)) + 1
        key, most = key * width + column, most * width
    return [np.unique(x) for x in np.split(key, ends)]


def reaches(x: np.ndarray, y: np.ndarray, threshold_percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= threshold_percent * (len(x) + len(y) - both)


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sketches do not rule the threshold out, with the estimate."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s = [np.frombuffer(b"".join(column_bytes(batch.column(k))), np.uint16).reshape(-1, REGISTERS) for k in ("s_a", "s_b")]
            n = [batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in ("n_a", "n_b")]
            about, keep = estimate(*s, *n, threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(about)], ["a", "b", "about"]).filter(pa.array(keep))

    near = (F.least("n_a", "n_b") + 1e-6) / F.greatest("n_a", "n_b") >= threshold
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").where(near), run, "a long, b long, about double")


def _confirmed(pairs: DataFrame, bodies: DataFrame, shingle: int, threshold_percent: int) -> DataFrame:
    """Pairs whose full sets of shingles, word by word, reach the threshold."""
    side = lambda x: bodies.select(F.col("node").alias(x), F.col("words").alias(f"s_{x}"))

    def run(batches):
        for batch in batches:
            keep = [reaches(*numbered_shingles([a, b], shingle), threshold_percent) for a, b in zip(column_bytes(batch.column("s_a")), column_bytes(batch.column("s_b")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b"), run, "a long, b long")


def _links_of_rest(rest: DataFrame, bodies: DataFrame, scratch: Scratch, shingle: int, threshold_percent: int) -> DataFrame:
    """All links between members of different components that share a bucket, of rest (band, node, label).

    Buckets of the same members count once. A bucket is cut into blocks of about BLOCK nodes, so that a large component
    has blocks of its own and small ones share some; each two blocks but those of one component meet in a task, which
    counts all common shingles by matrix products. What a task holds stays the same for any bucket; nodes that share no
    bucket never meet.
    """
    sign = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(20,0)")).alias(f"sign{k}") for k in (1, 2)]
    once = rest.groupBy("band").agg(F.count("*").alias("n"), *sign).groupBy("n", "sign1", "sign2").agg(F.min("band").alias("band")).select("band")
    nodes = scratch.save(rest.select("band", "node", "label").join(once, "band"), "crowd")
    by_label = scratch.save(nodes.groupBy("band", "label").agg(F.count("*").alias("n")), "by-label")
    pool = scratch.save(by_label.groupBy("band").agg(F.sum(F.when(F.col("n") < BLOCK, F.col("n"))).alias("pool")), "pool")
    large = F.col("n") >= BLOCK
    own = F.when(large, F.col("label"))
    part = F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))).otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.col("pool") / BLOCK)))
    placed = scratch.save(nodes.join(by_label, ["band", "label"]).join(pool, "band").select("band", "node", "label", own.alias("own"), F.xxhash64(F.coalesce(own, F.lit(-1)), part).alias("block")), "placed")
    blocks = placed.select("band", "own", "block").distinct()
    other = blocks.select("band", F.col("own").alias("own_2"), F.col("block").alias("block_2"))
    meet = blocks.join(other, "band").where("block <= block_2 and not (own is not null and own <=> own_2)").select("band", "block", "block_2", F.xxhash64("band", "block", "block_2").alias("task"))
    meet = scratch.save(meet, "meet")
    sides = meet.select("band", "block", "task", F.lit(0).alias("side")).unionAll(meet.where("block < block_2").select("band", F.col("block_2").alias("block"), "task", F.lit(1).alias("side")))
    held = placed.select("band", "block", "node", "label").join(bodies, "node").join(sides, ["band", "block"]).select("task", "side", "node", "label", "words")

    def run(batches):
        for group in _groups(batches):
            found = [x for x in _similar(*group, shingle, threshold_percent)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return map_arrow(held.repartition("task").sortWithinPartitions("task", "side", "node"), run, "a long, b long").distinct()


def _groups(batches):
    """side, node, label and words of each task, from rows sorted by it."""
    now, rows = None, []
    for batch in batches:
        for task, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), column_bytes(batch.column(4)), strict=True):
            if task != now and rows:
                yield tuple(zip(*rows, strict=True))
                rows = []
            now = task
            rows.append(row)
    if rows:
        yield tuple(zip(*rows, strict=True))


def _similar(side, node, label, bodies, shingle: int, threshold_percent: int):
    """Pairs of nodes with different labels whose sets are similar, between side 0 and side 1 or, with one side, within."""
    arrays = numbered_shingles(bodies, shingle)
    size = np.array([len(x) for x in arrays])
    _, column, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(arrays)), size)
    kept = count[column] > 1
    column, owner = (np.cumsum(count > 1) - 1)[column[kept]], owner[kept]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    first = side.index(1) if 1 in side else 0
    left, right = (slice(0, first), slice(first, None)) if first else (slice(None), slice(None))
    common = np.zeros((len(arrays[left]), len(arrays[right])), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        low, high = np.searchsorted(column, (at, at + 2048))
        part = np.zeros((len(arrays), 2048), np.float32)
        part[owner[low:high], column[low:high] - at] = 1
        common += part[left] @ part[right].T
    total = size[left][:, None] + size[right][None, :] - common
    labels = np.array(label)
    similar = (100 * common >= threshold_percent * total) & (labels[left][:, None] != labels[right][None, :])
    for i, j in np.argwhere(similar).tolist():
        yield node[i], node[j + first]


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold_percent: int = 80, keys: bool = False) -> DataFrame:
    """id, n_shingles, component_id, kept, one row for each input row; with keys also h, g (`row_key`) and has_words.

    Links documents whose sets of distinct word shingles have a Jaccard similarity of at least threshold_percent;
    A-Z are lower-cased, words end at ASCII white space, fewer words than a shingle count as one shingle. Nulls, empty
    texts and others without words link with nothing: component_id is their own id. Ids are of any type and only name
    components, by their least; repeated rows, and rows that share an id, are documents of their own. A component of rows
    without an id has a null component_id; kept are then all rows of one text of it. Texts of any length go through
    whole. Ties cannot arise, as sets decide. An empty table gives no rows; other columns do not matter.
    """
    spark, threshold = df.sparkSession, threshold_percent / 100
    s = Scratch(spark, "setsketch")
    sig = s.save(sketches(df, id_col, text_col, shingle), "sketches")
    rep = F.min(F.struct(F.col("id").isNull(), "id", "h", "g")).alias("rep")
    classes = sig.where("k1 is not null").groupBy("k1", "k2").agg(rep, F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    classes = s.save(classes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "rep.id", "rep.h", "rep.g", "n_shingles", "sketch"), "classes")

    def band_rows(batches):
        for batch in batches:
            if batch.num_rows:
                found = [band_keys(np.frombuffer(x, np.uint16)) for x in column_bytes(batch.column(1))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["band", "node"])

    bands = classes.select("node", "sketch").mapInArrow(band_rows, "band long, node long")
    shared = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = s.save(bands.join(shared.select("band", "leader"), "band"), "members")
    nodes = classes.select("node", "n_shingles", "sketch")
    first = members.where("node > leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    first = s.save(_likely(first, nodes, threshold), "first")
    wanted = classes.select("node", "h", "g").join(members.select("node").distinct(), "node", "left_semi")
    texts = df.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    bodies = s.save(word_bodies(texts.join(wanted, ["h", "g"]).dropDuplicates(["h", "g"])), "bodies")

    best = first.groupBy("a").agg(F.max_by("b", F.struct("about", "b")).alias("b"))
    label = components(s.save(_confirmed(best, bodies, shingle, threshold_percent), "links-1"), s, "cc-1")

    def unlinked(pairs: DataFrame) -> DataFrame:
        """Those in different components so far."""
        known = lambda x: label.select(F.col("node").alias(x), F.col("label").alias(f"l_{x}"))
        return pairs.join(known("a"), "a", "left").join(known("b"), "b", "left").where("coalesce(l_a, a) <> coalesce(l_b, b)").select("a", "b")

    second = unlinked(first.select("a", "b").join(best, ["a", "b"], "left_anti"))
    label = extended(label, s.save(_confirmed(second, bodies, shingle, threshold_percent), "links-2"), s, "cc-2")

    labelled = members.join(label, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n")).where("least < most and n > 2").select("band")
    rest = s.save(labelled.join(mixed, "band"), "rest")
    label = extended(label, s.save(_links_of_rest(rest, bodies, s, shingle, threshold_percent), "links-3"), s, "cc-3")

    placed = s.save(classes.select("node", "k1", "k2", "id").join(label, "node", "left").select("node", "k1", "k2", "id", F.coalesce("label", "node").alias("label")), "placed-classes")
    named = s.save(placed.groupBy("label").agg(F.min("id").alias("component_id")), "named")
    of_class = placed.join(named, "label").select("k1", "k2", "component_id", (F.col("node") == F.col("label")).alias("leads"))
    judged = sig.select("id", "h", "g", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2"], "left")
    wordless = F.col("k1").isNull()
    component = F.when(wordless, F.col("id")).otherwise(F.col("component_id"))
    kept = F.col("id").eqNullSafe(component) & (F.col("id").isNotNull() | wordless | F.coalesce("leads", F.lit(False)))
    more = ["h", "g", (~wordless).alias("has_words")] if keys else []
    return judged.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), kept.alias("kept"), *more)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows, with all their columns, one of each group: a row kept by `near_duplicates`, once for each id and text.

    Rows without words are groups of their own and stay. Of rows that agree in id and text but not in other columns, any one stays.
    """
    found = near_duplicates(docs, id_col, text_col, keys=True, **options).where("kept").select("h", "g", "has_words").distinct()
    rows = docs.select(*row_key(id_col, text_col), F.struct("*").alias("row")).join(found, ["h", "g"])
    rows = rows.withColumn("one", F.when(~F.col("has_words"), F.monotonically_increasing_id()))
    return rows.dropDuplicates(["h", "g", "one"]).select("row.*")


def op9_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`near_duplicates` of all documents at four words: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(spread(read_table(spark, sf_dir, "documents")), shingle=4)
