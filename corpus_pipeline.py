"""The corpus pipeline: documents in, token files out.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of documents;
the last returns a row for each document of the token files. Rows without an id or a text, empty and very long texts,
ties and repeated rows are as the operators state: null texts are never toxic, copies or contaminated, and are never drawn
into the mix; of rows that agree in id and text one stays. Other columns are carried along whatever their names, and an
empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridclim.llm.common import Scratch, read_table, small_batches
from gridclim.llm.decontaminate import drop_contaminated
from gridclim.llm.mixing import mixed_documents
from gridclim.llm.setsketch import drop_near_duplicates
from gridclim.llm.tokens import token_files
from gridclim.llm.toxicity import drop_toxic, train

#: Bytes of a partition that a stage returns, unless there are fewer than two partitions a core.
PART_BYTES = 8 << 20


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier chain calls toxic."""
    small_batches(spark)
    return compact(drop_toxic(docs, train(docs, read_table(spark, sf_dir, "labels"))), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, a similarity of 0.8): the one with the smallest id."""
    small_batches(spark)
    return compact(drop_near_duplicates(docs), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item's passage."""
    small_batches(spark)
    return compact(drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents to bring the sources to their target weights."""
    small_batches(spark)
    return compact(mixed_documents(docs), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and reads them back."""
    small_batches(spark)
    return token_files(docs, "pipeline-tokens")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]
#: The classifier, the sketches and the tokenizer have no SQL; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def compact(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """A stage's rows in no more partitions than the size of the documents it took needs, by Spark's estimate, and two for each
    core at least: else a table that comes in very many small parts is written in as many small files by every stage. Nothing
    is shuffled."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    return rows.coalesce(min(parts, 1 << 20))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
