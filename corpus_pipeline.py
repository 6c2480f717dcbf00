"""The corpus pipeline: quality rules, near-duplicate removal, removal of
repeated passages, packing. Each stage takes ``(spark, docs, sf_dir)``; its
result is written as Parquet and read again as the next one's ``docs``."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm.common import read_table
from replyscope.llm.near_dedup import near_duplicates
from replyscope.llm.packing import pack
from replyscope.llm.quality import judge, train_field
from replyscope.llm.substring_dedup import remove_repeats
from replyscope.session import Scratch

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
           "n_chars": "bigint"}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The field learns from the labels
    of the raw documents, so the decision on a document doesn't hang on which
    others come along. Null, empty and short texts go; repeated rows are judged
    each; an empty table gives no rows; further columns are left out."""
    field = train_field(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judge(docs, field, carry=COLUMNS).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group. Documents without an
    id stay; of rows that share an id, all stay or go."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    held = docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()])
    return held.join(kept, "doc_id").select(*COLUMNS).union(held.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; one that has
    nothing left is left out. Texts that lose nothing stay as they are, a null
    one as an empty one; rows that share an id are one document, rows without
    an id lose nothing; an empty table gives no rows."""
    schema = ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items() if c != "text")
    out = remove_repeats(docs, carry=schema)
    return out.where("n_removed = 0 or n_removed < n_words").select(
        "row.doc_id", F.col("kept_text").alias("text"), "row.lang", "row.source",
        F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("bigint"))
        .otherwise(F.col("row.n_chars")).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2,048 tokens. Null
    and empty texts are a piece of one token; repeated rows are packed each; an
    empty table gives no rows."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("best_fit_packing", packing)]

# SQL can express neither the decoded field nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table of its own, which
    is dropped once the next one is written."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        after = scratch.table(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = after
    return docs
