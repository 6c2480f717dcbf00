"""Readers for the input tables and the derived pair tables every operator
works on."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# A pair id holds the turn in its low bits; a turn or conversation that doesn't
# fit raises an error, so no two pairs share an id.
TURN_BITS = 20
N_PAIR_CATEGORIES = 10


def pair_id(conv_id: Column, turn: Column) -> Column:
    """``(conv_id, turn)`` as one id, in the same order."""
    limit = 1 << (62 - TURN_BITS)
    fits = turn.between(0, (1 << TURN_BITS) - 1) & conv_id.between(-limit, limit)
    return F.when(fits, F.shiftleft(conv_id, TURN_BITS) + turn).when(
        conv_id.isNotNull() & turn.isNotNull(),
        F.raise_error(F.lit("a turn or conversation number doesn't fit a pair id")).cast("bigint"))


def check_unique(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` if no two rows share the values of ``cols`` (nulls are equal),
    else an error naming one. Ticket, query and pair ids have to be unique:
    rows under one id count as one text. Runs a job, so it is opt-in."""
    again = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
    if again:
        raise ValueError(f"{', '.join(cols)} not unique: {tuple(again[0])[:-1]}")
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Ticket-shaped pairs: a ``user`` turn and the ``assistant`` turn that
    directly follows it in the same conversation.

    Turns are numbered 0..n-1 per conversation, so "next turn" is the
    equi-join on ``(conv_id, turn + 1)``: unique keys on both sides, no window
    over a whole (possibly huge) conversation.
    Output: ``id, customer_email, support_reply, category, conv_id, turn``.
    """
    user = (conversations.where(F.col("role") == "user")
            .select("conv_id", "turn", F.col("text").alias("customer_email")))
    reply = (conversations.where(F.col("role") == "assistant")
             .select("conv_id", (F.col("turn") - 1).alias("turn"),
                     F.col("text").alias("support_reply")))
    return (user.join(reply, ["conv_id", "turn"], "inner")
            .select(pair_id(F.col("conv_id"), F.col("turn")).alias("id"),
                    "customer_email", "support_reply",
                    F.concat(F.lit("c"), (F.col("conv_id") % N_PAIR_CATEGORIES)
                             .cast("string")).alias("category"),
                    "conv_id", "turn"))


def eval_pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Evaluation input ``id, category, customer_email, generated, reference``.

    The reference is the assistant turn after the user turn; the candidate is
    the assistant turn just before that user turn (the previous answer in the
    thread, a reuse baseline), or ``''`` when the thread has none, which
    exercises the empty-candidate rules of every metric."""
    pairs = pairs_from_conversations(conversations)
    previous = (conversations.where(F.col("role") == "assistant")
                .select("conv_id", (F.col("turn") + 1).alias("turn"),
                        F.col("text").alias("generated")))
    return (pairs.join(previous, ["conv_id", "turn"], "left")
            .select("id", "category", "customer_email",
                    F.coalesce("generated", F.lit("")).alias("generated"),
                    F.col("support_reply").alias("reference")))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_from_conversations(read_table(spark, sf_dir, "conversations"))


def eval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_pairs_from_conversations(read_table(spark, sf_dir, "conversations"))
