"""What each filter of a chain removes, in every order of the filters, from one cube over their failure flags.

A text's filters fail or pass by the text alone, so rows are first added up by part and flags. The cube over the flags and
the part then holds, for each set of filters, the row in which all of the set are false: what survives that set. A step
of an order is a pair of such sets, without its filter and with it; their difference is what the step removes.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def text_flags(rows: DataFrame, text_col: str) -> DataFrame:
    """The rows with `fails`, the sum of the bits of the filters A to D that a text fails: few words, repeated words, capital
    letters, symbols; null texts are empty."""
    text, capitals = F.coalesce(F.col(text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    seen = rows.withColumn("_words", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    seen = seen.withColumn("_n", F.size("_words").cast("long")).withColumn("_distinct", F.size(F.array_distinct("_words")).cast("long"))
    fails = [
        F.col("_n") < 50,
        100 * F.col("_distinct") < 65 * F.col("_n"),
        100 * (F.length(text) - F.length(F.translate(text, capitals, ""))).cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return seen.withColumn("fails", sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(fails)), F.lit(0))).drop("_words", "_n", "_distinct")


def flag_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, A to E, n, good, toxic: how many rows of a part fail just these filters.

    E fails for a row whose text a smaller id holds too, in any part. Copies share all other flags, so they are added up by a
    digest of the text (SHA-256) and the part before they meet, and only the rows of the text's smallest id pass E.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    rows = text_flags(rows.withColumn("digest", F.unhex(F.sha2("_text", 256))), "_text").groupBy("_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("_of")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = rows.join(marks, F.col("_id") == F.col("_of"), "left").select("_id", "part", "digest", "fails", "n", *[(F.col("n") * F.coalesce(x, F.lit(0))).alias(x) for x in ("good", "toxic")])
    counts = F.struct(*COUNTS)
    nameless = [F.sum(F.when(F.col("_id").isNull(), F.col(x)).otherwise(0)).alias(f"no_id_{x}") for x in COUNTS]
    copies = known.groupBy("digest", "part", "fails").agg(*[F.sum(x).alias(x) for x in COUNTS], *nameless, F.min("_id").alias("least"), F.min_by(counts, "_id").alias("of_least"))
    copies = Scratch(docs.sparkSession, "audit").save(copies, "copies")
    firsts = copies.groupBy("digest").agg(F.min("least").alias("first"))
    met = copies.join(firsts, "digest").withColumn("own", F.coalesce(F.col("least") == F.col("first"), F.lit(False)))
    single = {x: F.col(f"no_id_{x}") + F.when(F.col("own"), F.col(f"of_least.{x}")).otherwise(0) for x in COUNTS}
    both = met.select("part", "fails", F.explode(F.array(
        F.struct(F.lit(0).alias("e"), *[single[x].alias(x) for x in COUNTS]),
        F.struct(F.lit(1 << 4).alias("e"), *[(F.col(x) - single[x]).alias(x) for x in COUNTS]),
    )).alias("r"))
    found = both.select("part", (F.col("fails") + F.col("r.e")).alias("fails"), "r.n", "r.good", "r.toxic").where("n > 0").groupBy("part", "fails").agg(*[F.sum(x).alias(x) for x in COUNTS])
    return found.select("part", *[(F.getbit("fails", F.lit(k)) == 1).alias(f) for k, f in enumerate(FILTERS)], *COUNTS)


def survivors(flags: DataFrame) -> DataFrame:
    """part, subset (bit k: the k-th filter is in it), n, good, toxic: what is left of a part after the filters of a set.

    From the cube over the flags and the part: of the grouping sets with the part, the rows in which no chosen flag is true.
    """
    cube = flags.cube("part", *FILTERS).agg(F.grouping("part").alias("over"), *[F.grouping(f).alias(f"any_{f}") for f in FILTERS], *[F.sum(x).alias(x) for x in COUNTS])
    passed = cube.where(F.col("over") == 0)
    for f in FILTERS:
        passed = passed.where((F.col(f"any_{f}") == 1) | ~F.col(f))
    subset = sum(((1 - F.col(f"any_{f}")).cast("int") * (1 << k) for k, f in enumerate(FILTERS)), F.lit(0))
    return passed.select("part", subset.alias("subset"), *COUNTS)


def pairs(left: DataFrame) -> DataFrame:
    """part, before (a set), letter (a filter outside of it), kept, removed, good_lost, toxic_lost: each set joined with
    the same set and one filter more; sets that nothing survives count zero."""
    every = left.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("subset"))
    full = every.join(left, ["part", "subset"], "left").select("part", "subset", *[F.coalesce(x, F.lit(0)).alias(x) for x in COUNTS])
    letters = F.explode(F.array(*[F.struct(F.lit(f).alias("letter"), F.lit(1 << k).alias("bit")) for k, f in enumerate(FILTERS)]))
    without = full.select("part", F.col("subset").alias("before"), *[F.col(x).alias(f"{x}_before") for x in COUNTS], letters.alias("f")).select("*", "f.*").where(F.col("before").bitwiseAND(F.col("bit")) == 0)
    met = without.withColumn("subset", F.col("before") + F.col("bit")).join(full, ["part", "subset"])
    lost = {x: F.col(f"{x}_before") - F.col(x) for x in COUNTS}
    return met.select("part", "before", "letter", F.col("n").alias("kept"), lost["n"].alias("removed"), lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"))


def order_steps(spark: SparkSession) -> DataFrame:
    """filter_order, step, letter and before (the set of the filters of earlier steps) for every order of the filters."""
    orders = spark.range(1).select(F.explode(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])).alias("filter_order"))
    rows = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = [F.instr("filter_order", f) for f in FILTERS]
    before = sum((F.when(p < F.col("step"), 1 << k).otherwise(0) for k, p in enumerate(place)), F.lit(0))
    return rows.select("filter_order", "step", F.col("filter_order").substr(F.col("step"), F.lit(1)).alias("letter"), before.alias("before"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """A row for each part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null text is empty: it fails A alone of the filters on one text, and E where a smaller id's text is empty or null too. A null
    part is the empty string. A row without an id never fails E and makes none fail it; rows that repeat an id and a text count each, and
    neither makes the other fail. A document is good or toxic if any label of its id says so; labels without documents
    and null labels do not count. Texts are judged whole. An empty table gives no rows; other columns do not matter. After the sums by
    flags a part has 32 rows at most, and the steps, of which there are 600, are what is broadcast.
    """
    spark, filters = docs.sparkSession, len(FILTERS)
    steps = pairs(Scratch(spark, "audit").save(survivors(flag_counts(docs, labels, id_col, text_col, part_col)), "survivors"))
    size = F.bit_count("before")
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(filters - 1 - k)) for k in range(filters)]), size + 1)
    of_letter = steps.groupBy("part", "letter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(size == filters - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"),
    )
    known = steps.join(of_letter, ["part", "letter"]).join(F.broadcast(order_steps(spark)), ["letter", "before"])
    return known.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def op13_filter_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`filter_audit` of all documents by source."""
    return filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), seen AS (
  SELECT d.doc_id, d.part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
      coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS fail,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS toxic
  FROM words d
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), kinds AS (
  SELECT part, fail, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM seen GROUP BY part, fail
), hits AS (
  SELECT part, filter_order, n, n_good, n_toxic, fail, list_transform(range(1, 6), lambda i: fail[ascii(filter_order[i]) - 64]) AS in_order FROM kinds, orders
), steps AS (
  SELECT part, filter_order, unnest(range(1, 6)) AS step, n, n_good, n_toxic, fail, in_order, coalesce(list_position(in_order, true), 6) AS falls FROM hits
), counted AS (
  SELECT part, filter_order, step::INTEGER AS step, filter_order[step] AS letter, coalesce(sum(n) FILTER (falls > step), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (falls = step), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (falls < step AND in_order[step]), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (in_order[step] AND len(list_filter(fail, lambda x: x)) = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (falls = step), 0)::BIGINT AS good_lost, coalesce(sum(n_toxic) FILTER (falls = step), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counted
"""
