"""Chat formatting: multi-party perspective rotation.

For each participant of a conversation the dialogue is rendered with that speaker as assistant and the others as
named users; only the assistant's words count in the loss mask. The rendering is a row for each turn, with its place
in the whole text, so that a conversation of any length is spread over tasks: places are prefix sums over blocks of turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"
#: Turn numbers in a block, within which places are added up by one task.
BLOCK_TURNS = 1024


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """conv_id, perspective, turn, speaker, segment, char_start, char_end, mask_start, mask_end; one row for each turn and participant.

    Participants are the distinct non-null roles of a conversation; a conversation without any has no rows. Turns go
    by number (null first), then role and text, nulls first; equal rows are separate turns. A turn without a role is
    an unnamed user. A null text is empty. mask_start and mask_end bound the assistant's text with its end marker, in
    characters of the whole rendering, and are -1 for the others. A null conv_id is a conversation like others. Texts of any
    length are rendered whole; an empty table gives no rows, and other columns, of any name, do not matter.

    The turns meet their conversation's speakers, one short row each, in a join that Spark splits where one conversation
    holds very many turns; each view's blocks of turns are dealt out on their own.
    """
    said = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("speaker"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("said"))
    speakers = said.where(F.col("speaker").isNotNull()).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    target = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    name = F.when(F.col("speaker").isNull(), "user").otherwise(F.concat(F.lit("user name="), "speaker"))
    head = F.concat(F.lit(OPEN), F.when(target, "assistant").otherwise(name), F.lit(END))
    views = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of").withColumn("head", F.length(head)).withColumn("segment", F.concat(head, "said", F.lit(CLOSE + END)))
    views = views.withColumn("n", F.length("segment").cast("long")).withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 62))))
    sums = views.groupBy("conv_id", "perspective", "block").agg(F.sum("n").alias("n"))
    base = sums.select(F.col("conv_id").alias("of"), F.col("perspective").alias("seen_by"), F.col("block").alias("of_block"), (F.sum("n").over(Window.partitionBy("conv_id", "perspective").orderBy("block")) - F.col("n")).alias("base"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "speaker", "said")]
    local = F.sum("n").over(Window.partitionBy("conv_id", "perspective", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = views.withColumn("local", local).join(base, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("perspective") == F.col("seen_by")) & (F.col("block") == F.col("of_block")))
    start = F.col("base") + F.col("local")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "segment",
        start.alias("char_start"),
        (start + F.col("n")).alias("char_end"),
        F.when(target, start + F.col("head")).otherwise(F.lit(-1)).alias("mask_start"),
        F.when(target, start + F.col("n") - len(END)).otherwise(F.lit(-1)).alias("mask_end"),
    )


def op3_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`rotate` of all conversations."""
    return rotate(read_table(spark, sf_dir, "conversations"))


OP3_SQL = """
WITH said AS (SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS said FROM conversations),
views AS (
  SELECT s.*, p.perspective, coalesce(speaker = perspective, false) AS target,
    '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker IS NULL THEN 'user' ELSE 'user name=' || speaker END || chr(10) AS head
  FROM said s JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker IS NOT NULL) p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS segment,
    (sum(length(head || said || '<|im_end|>' || chr(10))) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, said ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS char_end
  FROM views
)
SELECT conv_id, perspective, turn, speaker, segment, char_end - length(segment) AS char_start, char_end,
  CASE WHEN target THEN char_end - length(segment) + length(head) ELSE -1 END AS mask_start, CASE WHEN target THEN char_end - 1 ELSE -1 END AS mask_end
FROM placed
"""
