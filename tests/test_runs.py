"""Ids, sessions, intermediate tables and files."""
import os

import pytest
from pyspark.sql import functions as F

from replyscope.operators.split import holdout_split, knowledge_base
from replyscope.plans.pipeline import run
from replyscope.session import Scratch, build_session, checkpoint_dir, materialize
from replyscope.sources.reports import read_tickets_csv, write_tickets_csv
from replyscope.sources.tables import (check_unique, eval_pairs_from_conversations,
                                       pairs_from_conversations)


def conversations(spark, turns):
    return spark.createDataFrame(
        [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t}") for c, t in turns],
        "conv_id long, turn long, role string, text string")


def test_long_conversations_keep_their_ids(spark):
    turns = [(1, t) for t in range(1000, 1004)] + [(2, t) for t in range(4)]
    rows = eval_pairs_from_conversations(conversations(spark, turns)).collect()
    assert len({r.id for r in rows}) == len(rows) == 4
    assert [r.reference for r in sorted(rows, key=lambda r: r.id)] == \
        ["text 1 1001", "text 1 1003", "text 2 1", "text 2 3"]
    with pytest.raises(Exception, match="doesn't fit"):
        pairs_from_conversations(conversations(spark, [(1, 1 << 20), (1, (1 << 20) + 1)])).collect()


def test_check_unique(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "id long")
    assert check_unique(df.distinct(), "id").count() == 2
    with pytest.raises(ValueError, match="1"):
        check_unique(df, "id")


def test_a_running_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = build_session()
        assert again.conf.get("spark.sql.shuffle.partitions") == "2000"
        assert again.conf.get("spark.sql.adaptive.enabled") == "false"
        assert build_session(shuffle_partitions=7).conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def files_below(spark):
    root = checkpoint_dir(spark).removeprefix("file:")
    return sum(len(f) for _, _, f in os.walk(os.path.join(root, "replyscope")))


def test_a_closed_run_leaves_no_files(spark):
    before = files_below(spark)
    with Scratch(spark) as scratch:
        kept = materialize(spark.range(10).toDF("id"))
        assert kept.count() == 10 and files_below(spark) > before
        other = scratch.table(spark.range(3).toDF("id"))
        scratch.drop(other)
    assert files_below(spark) == before


def test_a_pipeline_run_is_closed(spark):
    before = files_below(spark)
    tickets = pairs_from_conversations(conversations(
        spark, [(c, t) for c in range(30) for t in range(4)]))
    with Scratch(spark):
        assert run(tickets).scores.count() == 20
        assert files_below(spark) > before
    assert files_below(spark) == before


def test_a_large_holdout_gets_no_broadcast_hint(spark):
    t = spark.range(10).select("id", F.lit("c").alias("category"))
    h = holdout_split(t, 2)

    def plan(bound):
        return knowledge_base(t, h, holdout_bound=bound)._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(20)
    assert "strategy=broadcast" not in plan(10 ** 9) and "strategy=broadcast" not in plan(None)


def test_a_limit_only_shortens_the_holdout(spark):
    t = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("category"))
    assert holdout_split(t, 5, 12, limit=3).count() == 3
    assert holdout_split(t, 5, 2, limit=30).count() == 2
    assert holdout_split(t, 5, None, limit=7).count() == 7


def test_csv_keeps_texts(spark, tmp_path):
    texts = ["  hi ", "\ttab\t", "two\nlines", 'a "quote", and \\ more', "", None, " ", "é 東", "x,y"]
    df = spark.createDataFrame([(i, t, t, "c") for i, t in enumerate(texts)],
                               "id long, customer_email string, support_reply string, category string")
    write_tickets_csv(df, str(tmp_path / "t"))
    back = read_tickets_csv(spark, str(tmp_path / "t")).orderBy("id").collect()
    assert [r.customer_email for r in back] == texts == [r.support_reply for r in back]
