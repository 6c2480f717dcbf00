"""The corpus pipeline against a brute-force version of its stages."""
import re
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from replyscope.llm.quality import judge, train_field

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def first_of_groups(rows):
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return [(k, t) for k, t in rows if find(k) == k]


def without_repeats(rows, size=13):
    first = defaultdict(lambda: 1 << 62)
    for k, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - size + 1):
            first[tuple(w[i:i + size])] = min(k, first[tuple(w[i:i + size])])
    out = []
    for k, t in rows:
        w = WORD.findall(t or "")
        gone = {j for i in range(len(w) - size + 1) if first[tuple(w[i:i + size])] < k
                for j in range(i, i + size)}
        if not gone:
            out.append((k, t or ""))
        elif len(gone) < len(w):
            out.append((k, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_stages_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in judge(docs, train_field(docs, labels)).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    assert 0 < len(rows) < docs.count()
    rows = without_repeats(first_of_groups(rows))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for k, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(k, p, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes()))
                 for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)


def test_stages_keep_the_columns(spark, sf, tmp_path):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    odd = docs.limit(1).select(F.lit(None).cast("bigint").alias("doc_id"),
                               F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    docs = docs.union(odd).union(docs.limit(2)).withColumn("kept", F.lit("x")).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert stage(spark, docs.limit(0), sf).count() == 0
        assert out.count() <= docs.count()


def test_the_entry_works_without_this_part():
    """Without the subpackage the other queries are still there."""
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert 'evaluate_pairs' in q and 'pipeline' not in q; "
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120,
                   cwd=entry.__file__.rpartition("/")[0])


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_is_registered(n):
    assert any(q.startswith(f"op{n}_") for q in entry.queries())
