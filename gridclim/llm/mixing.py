"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash of their id and laid end to end; the stream is cut into blocks of
equal numbers of words. The schedule's slot i is the point i * a mod N of the golden-ratio lattice (a coprime to N,
close to N times the golden ratio), mapped through the sources' cumulative numbers of slots: every prefix of the
schedule holds the sources nearly in proportion, the whole of it exactly. A source's slot of rank r takes block
r mod n_blocks in pass r div n_blocks; the last pass ends at the word at which the target is met.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column_bytes, count_words, map_arrow, read_table, release, spread

WEIGHTS, MOST_PASSES, BLOCK_WORDS = (5, 2, 1), 3, 256
#: Slots of a chunk, within which ranks are counted; chunks add up by prefix sums.
CHUNK_BITS = 16
#: Documents of a bucket, within which places are added up by one task, for tables of over 4096 times as many.
BUCKET_DOCS = 4000


@dataclass
class Mixture:
    """targets: a row for each source; slots: the schedule; taken: a row for each document; placed: where each document's words stand in
    its source's stream (doc_id, source, size, src, at)."""

    targets: DataFrame
    slots: DataFrame
    taken: DataFrame
    placed: DataFrame


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size: the number of words (null: 0)."""

    def run(batches):
        release()
        for batch in batches:
            n = [count_words(t) for t in column_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "size"])

    kind = docs.schema[id_col].dataType
    return map_arrow(docs.select(F.col(id_col), F.col(source_col).cast("string"), text_col), run, T.StructType([T.StructField("doc_id", kind), T.StructField("source", T.StringType()), T.StructField("size", T.LongType())]))


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """source, src (its number), source_size, weight, target, and what the schedule needs; one row for each source.

    Sources by code point, null last, take the weights in turn and share the total size. A target stops at `most`
    times the source's size; what is over is shared again by weight until none is above. In order of cap over weight,
    a source is capped if the share by weight of what the earlier caps leave reaches its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("long")
    all_sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("src", F.row_number().over(by_name).cast("long") - 1).withColumn("weight", turn).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before, after, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    capped = all_sources.withColumn("capped", left / F.sum("weight").over(after) * F.col("weight") >= F.col("cap"))
    free = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0))
    share = free / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole) * F.col("weight")
    size, target = F.col("source_size"), F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return (
        capped.withColumn("target", target)
        .withColumn("take", F.floor(F.col("target") + 0.5))
        .withColumn("n_blocks", F.ceil(size / block_words))
        .withColumn("passes", F.when(size > 0, F.expr("take div source_size")).otherwise(F.lit(0)))
        .withColumn("rest", F.when(size > 0, F.col("take") % size).otherwise(F.lit(0)))
        .withColumn("n_slots", F.col("passes") * F.col("n_blocks") + F.ceil(F.col("rest") / block_words))
        .drop("cap")
    )


def golden_step(n: int) -> int:
    """The number coprime to n that is closest to n times the golden ratio's fraction."""
    near = round(n * (5**0.5 - 1) / 2)
    return next(a for k in range(n + 1) for a in (near + k, near - k) if 0 < a and gcd(a, n) == 1) if n > 1 else 1


def lattice(i: np.ndarray, step: int, n: int) -> np.ndarray:
    """i * step mod n without overflow, for n up to 2**40."""
    i, n = i.astype(np.uint64), np.uint64(n)
    high, low = np.uint64(step >> 20), np.uint64(step & 0xFFFFF)
    return (((i * high % n) << np.uint64(20)) % n + i * low % n) % n


def schedule(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """slot, src, rank, pass and block of every slot."""
    rows = targets.select("src", "n_slots").orderBy("src").collect()
    ends = np.cumsum([0] + [r.n_slots for r in rows])[1:].astype(np.uint64)
    numbers = np.array([r.src for r in rows], np.int64)
    total = int(ends[-1]) if len(ends) else 0
    step = golden_step(total)

    def run(batches):
        for batch in batches:
            slot = batch.column(0).to_numpy()
            if len(slot):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers[np.searchsorted(ends, lattice(slot, step, total), "right")])], ["slot", "src"])

    drawn = spark.range(total).select(F.col("id").alias("slot")).mapInArrow(run, "slot long, src long").withColumn("chunk", F.shiftright("slot", CHUNK_BITS))
    counts = drawn.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    base = counts.select("src", "chunk", (F.sum("n").over(Window.partitionBy("src").orderBy("chunk")) - F.col("n")).alias("base"))
    local = drawn.withColumn("local", F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1)
    ranked = local.join(base, ["src", "chunk"]).join(targets.select("src", "n_blocks"), "src")
    return ranked.select("slot", "src", (F.col("base") + F.col("local")).alias("rank"), "n_blocks").select("slot", "src", "rank", F.expr("rank div n_blocks").alias("pass"), (F.col("rank") % F.col("n_blocks")).alias("block"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: int = MOST_PASSES, block_words: int = BLOCK_WORDS) -> Mixture:
    """The mixture of all documents; taken has doc_id, source, size, source_size, target, taken for each input row.

    Null texts and texts without words have size 0 and are never taken; a null source is a source of its own; repeated
    rows are separate documents, and ids, null ones too, only decide the order. The order hashes the id as text by MD5
    (null: empty); ties go by id, then size. Texts of any length count whole. An empty table, or one without words, takes
    nothing; other columns do not matter.
    """
    spark = docs.sparkSession
    s = Scratch(spark, "mixing")
    sized = s.save(sizes(docs, id_col, text_col, source_col), "sizes")
    targets = s.save(source_targets(sized, weights, most, block_words), "targets")
    slots = schedule(spark, targets)

    # as many hexadecimal digits of the key as leave a few thousand documents of a source in a bucket, at any size of the table
    digits = max(3, (sized.count() // BUCKET_DOCS).bit_length() // 4 + 1)
    known = sized.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).withColumn("bucket", F.substring("key", 1, digits))
    known = known.join(targets.select(F.col("source").alias("name"), "src", "source_size", "target", "passes", "rest"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sums = known.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    base = sums.select("src", "bucket", (F.sum("n").over(Window.partitionBy("src").orderBy("bucket")) - F.col("n")).alias("base"))
    order = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = s.save(known.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).join(base, ["src", "bucket"]).withColumn("at", F.col("base") + F.col("before")).drop("key", "bucket", "base", "before"), "placed")

    picks = slots.join(targets.select("src", "passes", "rest"), "src").withColumn("cut", F.when(F.col("pass") < F.col("passes"), block_words).otherwise(F.least(F.lit(block_words), F.col("rest") - F.col("block") * block_words)))
    picks = picks.groupBy("src", "block").agg(F.count_if(F.col("cut") == block_words).alias("whole"), F.max(F.when(F.col("cut") < block_words, F.col("cut"))).alias("cut"))
    first, last = F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.lit(0), F.col("at") - F.col("block") * block_words)
    end = F.least(F.lit(block_words), F.col("at") + F.col("size") - F.col("block") * block_words)
    words = F.col("whole") * (end - begin) + F.greatest(F.lit(0), F.least(F.coalesce("cut", F.lit(0)), end) - begin)
    taken = pieces.join(picks, ["src", "block"]).groupBy("src", "at").agg(F.sum(words).alias("taken"))
    found = placed.join(taken.withColumn("some", F.lit(True)), ["src", "at"], "left")
    out = found.select("doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))
    return Mixture(targets, slots, out, placed)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows, with all their columns, each as often as the mixture takes it, rounded to whole documents.

    Rows that share an id are taken equally often; else as in `mix`.
    """
    taken = mix(docs, id_col, **options).taken.groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).where("taken > 0")
    copies = taken.select(F.col("doc_id").alias("of"), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).where("copies > 0")
    rows = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row")).join(copies, F.col("id").eqNullSafe(F.col("of")))
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def scheduled_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: int = MOST_PASSES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, source, n_words, doc_ids and text of each slot of the schedule: the mixture in the order of training, a block of a source's
    words to a slot, with one space between words.

    Written by `write_token_files` with `slot` as the id, the files hold the mixture in this order. A document's words are in as many
    blocks as they reach, in order; the last pass of a source ends at the word at which its target is met. Rows that share id,
    source and size are told apart by their texts. Else as in `mix`.
    """
    m = mix(docs, id_col, text_col, source_col, weights, most, block_words)
    same = ["doc_id", "source", "size"]
    words = F.array_remove(F.split(text_col, r"[\x20\x09-\x0D]+"), "")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("words"), F.xxhash64(text_col).alias("h")).withColumn("size", F.size("words").cast("long")).where("size > 0")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("h")))
    placed = m.placed.where("size > 0").withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("at"))).select(*same, "nth", "src", "at")
    met = rows.alias("r").join(placed.alias("p"), [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*same, "nth"]]).select("r.doc_id", "r.source", "p.src", "p.at", "r.size", "r.words")

    def piece(block):
        begin = F.greatest(F.lit(0), block * block_words - F.col("at"))
        end = F.least("size", (block + 1) * block_words - F.col("at"))
        return F.struct(block.alias("block"), (F.col("at") + begin - block * block_words).alias("offset"), F.slice("words", (begin + 1).cast("int"), (end - begin).cast("int")).alias("words"))

    blocks = F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}"))
    pieces = met.select("doc_id", "source", "src", F.explode(F.transform(blocks, piece)).alias("x")).select("doc_id", "source", "src", "x.*")
    cut = F.when(F.col("pass") < F.col("passes"), block_words).otherwise(F.least(F.lit(block_words), F.col("rest") - F.col("block") * block_words))
    slots = m.slots.join(m.targets.select("src", "passes", "rest"), "src").select("slot", "src", "block", cut.alias("cut"))
    dealt = slots.join(pieces, ["src", "block"]).where(F.col("offset") < F.col("cut"))
    kept = F.slice("words", F.lit(1), F.greatest(F.lit(0), F.least(F.size("words"), (F.col("cut") - F.col("offset")).cast("int"))))
    slotted = dealt.select("slot", "source", F.struct("offset", "doc_id", kept.alias("words")).alias("x")).groupBy("slot").agg(F.first("source").alias("source"), F.array_sort(F.collect_list("x")).alias("x"))
    every = F.flatten(F.transform("x", lambda p: p["words"]))
    return slotted.select("slot", "source", F.size(every).cast("long").alias("n_words"), F.transform("x", lambda p: p["doc_id"]).alias("doc_ids"), F.concat_ws(" ", every).alias("text"))


def op7_golden_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`mix` of all documents: what it takes of each."""
    return mix(spread(read_table(spark, sf_dir, "documents"))).taken.select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM sized GROUP BY source
), weighed AS (
  SELECT *, ([5, 2, 1])[src % 3 + 1]::BIGINT AS weight, 3 * source_size AS cap FROM sources
), judged AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE * weight >= cap AS capped FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
    ELSE (sum(source_size) OVER () - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE / (sum(CASE WHEN NOT capped THEN weight END) OVER ())::DOUBLE * weight END AS target FROM judged
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS take,
    (sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - s.size AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (take // source_size) * size + greatest(0, least(pos + size, take % source_size) - pos) END::BIGINT AS taken
FROM placed
"""
