"""Exact top-k search by inner product over vector-approximation files.

Each tile of vectors is a small approximation file: in every dimension the tile's values fall into cells of equal
numbers, and a vector is the numbers of its cells, a byte a dimension. A block of queries scans a tile's cells alone: with a cell's
least and greatest value they bound the score from below and above. Of all vectors whose upper bound reaches the k-th best lower
bound the exact ones are read in the order of their upper bounds, the first few at once; what can still reach the k-th
exact score is read next, after which the result is certain.

Rows of equal vectors are one class from the start: a class is scanned and scored once, and as only its smallest ids can be
in a result, it keeps no more of them than a result and the query itself need.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batches_of, map_arrow, read_table, release

#: Cells of a dimension; bytes of a tile's vectors and of a block of queries, as doubles.
CELLS, TILE_BYTES, BLOCK_BYTES = 64, 16 << 20, 4 << 20
#: Exact vectors read first, and queries of a block scanned together.
FIRST, LANES = 16, 64


def whole_vectors(df: DataFrame, vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The rows whose vector has components, all of them finite, with `v`: array of floor(scale * x), as long."""
    x = F.col(vector_col)
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    whole = lambda e: F.when(F.abs(e) < 2.0**63, F.floor(e)).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("long"))
    return df.where(x.isNotNull() & (F.size(x) > 0) & sound).withColumn("v", F.transform(x, lambda e: whole(e.cast("double") * scale)))


def approximate(values: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers of each vector (n, d), and the least and greatest value of each cell (d, cells)."""
    n, d = values.shape
    codes = np.zeros((n, d), np.uint8)
    low, high = np.zeros((d, cells)), np.zeros((d, cells))
    at = np.linspace(0, n, cells, endpoint=False).astype(np.int64)[1:]
    for k in range(d):
        ranked = np.sort(values[:, k])
        marks = np.unique(ranked[at])
        code = np.searchsorted(marks, values[:, k], "right")
        codes[:, k] = code
        edge = np.searchsorted(ranked, marks)
        begin, end = np.append(0, edge), np.append(edge, n)
        low[k, : len(begin)], high[k, : len(begin)] = ranked[np.minimum(begin, n - 1)], ranked[np.maximum(end, 1) - 1]
    return codes, low, high


def bounds(queries: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of queries and approximated vectors.

    From the middles and half widths of the cells; where doubles can't hold all sums exactly, bounds give way by the error.
    """
    d = np.arange(codes.shape[1])
    least, most = low[d, codes], high[d, codes]
    middle, half = queries @ ((least + most) / 2).T, np.abs(queries) @ ((most - least) / 2).T
    size = codes.shape[1] * np.abs(queries).max(initial=0) * max(np.abs(least).max(initial=0), np.abs(most).max(initial=0))
    half += size * 2.0**-48 if size >= 2.0**50 else 0
    return middle - half, middle + half


TILE = T.StructType([T.StructField("tile", T.StringType()), T.StructField("dim", T.IntegerType()), T.StructField("classes", T.BinaryType()), T.StructField("codes", T.BinaryType()), T.StructField("cells", T.BinaryType())])
BLOCK = T.StructType([T.StructField("block", T.StringType()), T.StructField("dim", T.IntegerType()), T.StructField("queries", T.BinaryType()), T.StructField("vectors", T.BinaryType())])
BOUND = T.StructType([T.StructField("query", T.LongType()), T.StructField("cls", T.LongType()), T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())])


def _packed(classes: DataFrame, size: int, schema: T.StructType, pack) -> DataFrame:
    """cls, v in runs of a partition's vectors of one dimension: pack(name, ids, values) makes a row's columns of at most `size` bytes of doubles."""

    def run(batches):
        from pyspark import TaskContext

        release()
        part, held, count = TaskContext.get().partitionId(), {}, 0

        def flush(dim: int):
            nonlocal count
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            row = pack(f"{part}-{count}", dim, ids, values)
            count += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int32(), *[pa.binary()] * (len(row) - 2)), strict=True)], schema.names)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy().astype(np.float64)
            first = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                own, room = np.flatnonzero(sizes == dim), max(1, size // (8 * dim))
                for at in range(0, len(own), room):
                    take = own[at : at + room]
                    have = held.setdefault(dim, [])
                    if have and sum(len(x[0]) for x in have) + len(take) > room:
                        yield flush(dim)
                        have = held.setdefault(dim, [])
                    have.append((ids[take], flat[first[take][:, None] + np.arange(dim)]))
        for dim in list(held):
            yield flush(dim)

    return map_arrow(classes.select("cls", "v"), run, schema)


def tiles(classes: DataFrame, cells: int = CELLS, size: int = TILE_BYTES) -> DataFrame:
    """The approximation files: a row for each tile."""

    def pack(name, dim, ids, values):
        codes, low, high = approximate(values, cells)
        return name, dim, ids.astype("<i8").tobytes(), codes.tobytes(), np.stack([low, high]).tobytes()

    return _packed(classes, size, TILE, pack)


def blocks(classes: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    return _packed(classes, size, BLOCK, lambda name, dim, ids, values: (name, dim, ids.astype("<i8").tobytes(), values.tobytes()))


def scan(pairs: DataFrame, k: int) -> DataFrame:
    """query, cls, lower, upper: of each tile and block of queries the vectors that can be among a query's k best of the tile."""

    def run(batches):
        release()
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                classes, queries = np.frombuffer(row["classes"], "<i8"), np.frombuffer(row["queries"], "<i8")
                codes, vectors = np.frombuffer(row["codes"], np.uint8).reshape(-1, dim), np.frombuffer(row["vectors"]).reshape(-1, dim)
                low, high = np.frombuffer(row["cells"]).reshape(2, dim, -1)
                for at in range(0, len(queries), LANES):
                    lower, upper = bounds(vectors[at : at + LANES], codes, low, high)
                    n = lower.shape[1]
                    least = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(lower), -np.inf)
                    q, c = np.nonzero(upper >= least[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(queries[at + q]), pa.array(classes[c]), pa.array(lower[q, c]), pa.array(upper[q, c])], BOUND.names)

    return pairs.select("dim", "classes", "codes", "cells", "queries", "vectors").mapInArrow(run, BOUND)


def top_k(vectors: DataFrame, asks, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, cells: int = CELLS, tile_bytes: int = TILE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, id, score: for each row for which the condition `asks` holds its k best of all other rows.

    Components are floor(scale * x), scores their inner products, as long; a component or a
    score beyond a long is an error (the latter in Spark's ANSI mode). Ties go to the smaller id,
    null last. Rows with a null or empty vector, or a component that is null or not finite, take no part; vectors of other
    lengths than the query's are no candidates. Rows that repeat an id are rows of their own: each is a candidate of the others, and
    a query where `asks` says so. An empty table gives no rows; other columns do not matter.
    """
    spark = vectors.sparkSession
    s, most = Scratch(spark, "vectors"), k + 1
    own = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    rows = whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"), F.coalesce(asks, F.lit(False)).alias("asks")), "x", scale).select("id", "v", "asks")
    least = rows.select("id", "v").withColumn("place", F.row_number().over(own)).where(F.col("place") <= most)
    counts = rows.groupBy("v").agg(F.max("asks").alias("asks"))
    classes = s.save(least.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("ids")).join(counts, "v").select(F.monotonically_increasing_id().alias("cls"), "v", "asks", F.col("ids.id").alias("ids")), "classes")
    asked = classes.where("asks")
    with batches_of(spark):
        s.save(tiles(classes, cells, tile_bytes), "tiles")
        s.save(blocks(asked, block_bytes), "blocks")
    tile, block = spark.read.schema(TILE).parquet(s.path("tiles")), spark.read.schema(BLOCK).parquet(s.path("blocks"))
    grid = tile.select("tile", "dim").join(block.select("block", "dim"), "dim").join(tile.drop("dim"), "tile").join(block.drop("dim"), "block")
    with batches_of(spark):
        found = s.save(scan(grid, most), "bounds")

    best = Window.partitionBy("query").orderBy(F.desc("lower"))
    floor = found.withColumn("n", F.row_number().over(best)).where(F.col("n") == most).select("query", F.col("lower").alias("floor"))
    open_ = found.join(floor, "query", "left").where(F.col("floor").isNull() | (F.col("upper") >= F.col("floor")))
    ordered = s.save(open_.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("upper"), "cls"))).select("query", "cls", "upper", "n"), "ordered")
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x)

    def read(wanted: DataFrame) -> DataFrame:
        """Reads the exact vectors."""
        return wanted.join(classes.select("cls", "v"), "cls").join(asked.select(F.col("cls").alias("query"), F.col("v").alias("q")), "query").select("query", "cls", product.alias("score"))

    first = s.save(read(ordered.where(F.col("n") <= max(FIRST, most))), "first")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    sure = first.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == most).select("query", F.col("score").alias("sure"))
    rest = ordered.where(F.col("n") > max(FIRST, most)).join(sure, "query").where(F.col("upper") >= F.col("sure"))
    exact = first.unionByName(read(rest))

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "cls", "nth")
    members = exact.join(classes.select("cls", F.posexplode("ids").alias("nth", "id")), "cls").withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= most)
    results = s.save(members.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "cls", "id", "score"))).alias("best")), "results")
    queries = rows.where("asks").select(F.col("id").alias("query_id"), "v").join(asked.select(F.col("cls").alias("query"), "v"), "v").select("query_id", "query").join(results, "query")
    place = F.array_position(F.transform("best", lambda b: (b["cls"] == F.col("query")) & b["id"].eqNullSafe(F.col("query_id"))), F.lit(True))
    others = F.when(place > 0, F.filter("best", lambda b: b["place"] != place)).otherwise(F.col("best"))
    out = queries.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "b"))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.id").alias(id_col), F.col("b.score").alias("score"))


def op11_approximation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`top_k` of all embeddings for every fiftieth id."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM sound q JOIN sound c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
