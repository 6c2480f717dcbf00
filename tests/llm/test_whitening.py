"""Whitening against plain arithmetic on Python integers and numpy."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from replyscope.llm import queries
from replyscope.llm.whitening import cross_products, whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows):
    """Result rows by (vec_id, component) of rows of one vector length."""
    usable = [(i, v) for i, v in rows
              if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in usable]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[n * x[j] - s[j] for j in range(d)] for x in fit]
    v = np.array([[sum(r[i] * r[j] for r in centred) / n ** 3 for j in range(d)]
                  for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:4]
    out = []
    for i, x in xs:
        away = [n * x[j] - s[j] for j in range(d)]
        for c, o in enumerate(order, 1):
            w = float(np.array(away) / n @ vectors[:, o])
            out.append((i, c, n, sum(a * a for a in away),
                        abs(w / math.sqrt(values[o])), values[o] / np.trace(v)))
    return sorted(out, key=lambda r: r[:2])


def compare(df, rows):
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained)
                  for r in df.collect()), key=lambda r: r[:2])
    want = brute(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    for n, d, top in ((1, 1, 3), (63, 4, 300), (64, 3, 1), (65, 5, 2 ** 20), (200, 6, 2 ** 61)):
        x = rng.integers(-top, top + 1, (n, d))
        x[:, 0] = x[0, 0]                              # a constant dimension has no planes
        sums, product = cross_products(x)
        rows = [[int(v) for v in r] for r in x]
        assert [int(v) for v in sums] == [sum(r[j] for r in rows) for j in range(d)]
        for i in range(d):
            for j in range(i, d):
                assert int(product[i, j]) == sum(r[i] * r[j] for r in rows)


def test_equals_plain_arithmetic(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(7)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(50)] + [(7, rows[7][1])]
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 5), (2002, [float("nan")] + [0.0] * 6),
             (2003, [float("-inf")] + [0.0] * 6), (2004, [])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("x", "n", "d", "component", "deviation"):
        df = df.withColumn(name, F.lit("clash"))
    out = whiten(df)
    compare(out, [r for r in rows if r[1] != []])
    worst = {r.identity_error for r in out.select("identity_error").collect()}
    assert len(worst) == 1 and worst.pop() < 1e-9


def test_query_on_the_table(spark, sf):
    rows = [(r.vec_id, list(r.embedding))
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(queries.op11_whitening(spark, sf), rows)


def test_odd_tables(spark):
    def result(rows):
        return sorted(whiten(spark.createDataFrame(rows, SCHEMA)).collect(),
                      key=lambda r: (r.vec_id is None, r.vec_id, r.component))

    assert result([]) == []
    assert result([(1, None), (2, [])]) == []
    one = result([(1, [0.5, 0.25]), (None, [0.5, 0.25])])       # one vector: no variance
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error)
            for r in one] == [(v, c, 1, 0, None, 0.0, None) for v in (1, None) for c in (1, 2)]
    flat = result([(1, [0.0, 1.0, 5.0]), (2, [1.0, 1.0, 5.0])])     # variance in one dimension
    assert [r.whitened is None for r in flat] == [False, True, True] * 2
    assert [abs(r.whitened) for r in flat if r.whitened is not None] == [1.0, 1.0]
    assert flat[0].identity_error < 1e-9 and flat[0].explained == 1.0
    mixed = result([(1, [0.0]), (2, [1.0]), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (5, [2.0, 3.0])])
    assert [(r.vec_id, r.component, r.n) for r in mixed] == \
        [(1, 1, 2), (2, 1, 2), (3, 1, 3), (3, 2, 3), (4, 1, 3), (4, 2, 3), (5, 1, 3), (5, 2, 3)]
    wide = result([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])
    assert [r.deviation for r in wide if r.component == 1][:2] == [None, None]
    assert all(r.n == 3 for r in wide)
