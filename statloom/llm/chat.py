r"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn is written as ``<|role|>ROLE<|text|>TEXT<|end|>``. Inside roles and
texts every ``<``, any backslashes, ``|`` gets one more backslash, so no text
can hold a mark, and dropping one backslash gives the text back.

Each assistant turn is an example of its own: its context is all turns before
it and only its text is trainable. All examples of a conversation are prefixes
of one string, so that string is stored once, turn by turn, and an example is
a row of offsets into it: where its context ends, where the trainable span
begins and ends, and where the example ends. The output grows with the
conversations, not with the square of their turns. ``example_texts`` spells
examples out.

Defined results: turns are ordered by turn, then role and text, nulls first;
null roles and texts are empty; a conversation without assistant turns has
turns but no examples; rows with a null conv_id are one conversation; other
columns are ignored, whatever their names; an empty table gives no rows. Reading
back fails if the context of an example is not all turns before it. The digest of a conversation needs its turns in one row;
formatting alone does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, start, formatted, mask_start, mask_end): mask offsets are null for turns that are not trained on."""
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    made = rows.select("conv_id", "turn", "role", "text", F.concat(head, body, F.lit(END)).alias("formatted"), F.length(head).alias("head"), F.length(body).alias("body"))
    by = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = made.select(
        "conv_id", (F.row_number().over(by) - 1).alias("pos"), "role", "formatted", "head", "body",
        (F.sum(F.length("formatted").cast("bigint")).over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.length("formatted")).alias("start"),
    )
    trained = F.col("role") == TRAINED
    return placed.select(
        "conv_id", "pos", "start", "formatted",
        F.when(trained, F.col("start") + F.col("head")).alias("mask_start"),
        F.when(trained, F.col("start") + F.col("head") + F.col("body")).alias("mask_end"),
    )


def write_examples(spark: SparkSession, conversations: DataFrame, folder: str) -> str:
    """Writes ``turns`` (the formatted text) and ``examples`` (offsets into it)."""
    format_turns(conversations).write.parquet(f"{folder}/formatted")
    made = spark.read.parquet(f"{folder}/formatted")
    made.select("conv_id", "pos", "start", "formatted").write.parquet(f"{folder}/turns")
    examples = made.where("mask_start IS NOT NULL").select("conv_id", F.col("pos").alias("example"), F.col("start").alias("context_end"), "mask_start", "mask_end", (F.col("start") + F.length("formatted")).alias("example_end"))
    examples.write.parquet(f"{folder}/examples")
    delete(spark, f"{folder}/formatted")
    return folder


def example_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, example, text, mask_start, mask_end) with each example's text spelled out."""
    turns, examples = spark.read.parquet(f"{folder}/turns"), spark.read.parquet(f"{folder}/examples")
    t, e = turns.alias("t"), examples.alias("e")
    rows = e.join(t, F.expr("e.conv_id <=> t.conv_id AND t.pos <= e.example"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("t.pos", "t.formatted"))), lambda x: x["formatted"]), "")
    return rows.groupBy("e.conv_id", "e.example", "e.mask_start", "e.mask_end").agg(text.alias("text")).select("conv_id", "example", "text", "mask_start", "mask_end")


def _joined(pieces: Column) -> Column:
    """Strings of (pos, s) structs in order of pos, end to end."""
    return F.array_join(F.transform(F.sort_array(pieces), lambda x: x["s"]), "")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each conversation, from the written files alone."""
    turns, examples = spark.read.parquet(f"{folder}/turns").alias("t"), spark.read.parquet(f"{folder}/examples").alias("e")
    along = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("ahead", F.sum(F.length("formatted").cast("bigint")).over(along) - F.length("formatted")).alias("t")
    rows = turns.join(examples, F.expr("t.conv_id <=> e.conv_id AND t.pos = e.example"), "left")
    parts = F.split("formatted", r"<\|(?:role|text|end)\|>")
    masked = F.substring(F.col("formatted"), F.col("mask_start") - F.col("start") + 1, F.col("mask_end") - F.col("mask_start"))
    rows = rows.select(
        "t.conv_id", "pos", "formatted", F.concat(unescape(F.get(parts, F.lit(1))), F.lit("\n"), unescape(F.get(parts, F.lit(2))), F.lit("\n")).alias("turn_text"),
        # An example's context is all text before its turn, no more and no less.
        F.when(F.col("context_end") != F.col("ahead"), F.raise_error(F.lit("an example's context is not the turns before it"))).when(F.col("mask_start").isNotNull(), unescape(masked)).alias("lost"),
    )
    found = rows.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        _joined(F.collect_list(F.struct("pos", F.col("turn_text").alias("s")))).alias("all_text"),
        _joined(F.collect_list(F.when(F.col("lost").isNotNull(), F.struct("pos", F.col("lost").alias("s"))))).alias("lost"),
        F.sum(F.length("formatted").cast("bigint")).alias("formatted_chars"),
    )
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return found.select("conv_id", "n_turns", sha("all_text").alias("turns_sha256"), F.length("lost").cast("bigint").alias("loss_chars"), sha("lost").alias("loss_sha256"), "formatted_chars")


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and one, numbered -7, whose texts look like marks of other templates."""
    probe = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    return conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(probe)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') AS er, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS et FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length(er) + length(et) + 23) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
