"""A fast subset of the driver's correctness check: Spark query vs its
DuckDB oracle on the sf0.001 tables (``tools/check_oracles.py`` runs all)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from replyscope.plans.queries import QUERIES
from replyscope.sources.tables import TABLES

SUBSET = ("pairs_from_conversations", "ticket_generate", "holdout_split", "tfidf_vocab",
          "topk_self_excluded", "topk_zero_pad", "topk_dense", "token_alignment_prf",
          "rouge_l", "heuristic_judge", "judge_parse", "score_rows", "summary_text",
          "llm_complete_stub", "tickets_csv", "per_email_json", "report_files")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()),
                        key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, sf, con, name):
    got = _rows(E.queries()[name](spark, sf).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) and got[1] == want[1]


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
