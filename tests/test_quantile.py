"""Exact medians against sorting."""
import math
import random
from statistics import median

import pytest

from replyscope.operators.quantile import exact_medians


def check(spark, rows, few):
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: (r.n, r.median) for r in exact_medians(df, "v", ["g"], few).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        held = [v for k, v in rows if k == g and v is not None and not math.isnan(v)]
        want[g] = (len(held), median(held) if held else None)
    assert got.keys() == want.keys()
    for g, (n, m) in want.items():
        assert got[g][0] == n
        assert got[g][1] == m or math.isclose(got[g][1], m, rel_tol=1e-15), g


@pytest.mark.parametrize("few", [100_000, 50])
def test_equals_sorting(spark, few):
    rng = random.Random(few)
    rows = [("normal", rng.gauss(0, 1)) for _ in range(6001)]
    rows += [("even", rng.random()) for _ in range(5000)]
    # Half of the rows share a value, and the middle pair is at its edge.
    rows += [("hot", 1.0) for _ in range(3000)] + [("hot", 2 + rng.random()) for _ in range(3000)]
    rows += [("wide", 10 ** rng.uniform(-300, 300) * rng.choice((-1, 1))) for _ in range(4000)]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None), (None, 3.0), (None, 8.0),
             ("nan", float("nan")), ("nan", 5.0)]
    rows += [("ties", float(rng.randrange(4))) for _ in range(2000)]
    check(spark, rows, few)


def test_empty_and_ungrouped(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_medians(df, "v", ["g"]).collect() == []
    df = spark.range(1001).selectExpr("cast(id as double) as v")
    assert [(r.n, r.median) for r in exact_medians(df, "v", [], 20).collect()] == [(1001, 500.0)]
