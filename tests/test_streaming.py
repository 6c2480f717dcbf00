import os
import tempfile

from pyspark.sql import functions as F

from replyscope.config import RunConfig
from replyscope.operators.split import corpus, split
from replyscope.operators.tfidf import fit_vocabulary
from replyscope.plans.generate import build_index, generate, update_index
from replyscope.sources.tables import read_table
from replyscope.sources.tickets import tickets_from_table
from replyscope.streaming.scoring import answer_stream


def test_stream_matches_batch(spark, sf):
    cfg = RunConfig(exclude_self=False)
    t = tickets_from_table(read_table(spark, sf, "documents"), "doc_id")
    kb, holdout = split(t)
    vocab = fit_vocabulary(corpus(kb))
    queries = holdout.select(F.col("id").alias("query_id"), F.col("customer_email").alias("query_email"))
    base = tempfile.mkdtemp(prefix="replyscope-stream-", dir="/tmp")
    src, out = os.path.join(base, "incoming"), os.path.join(base, "out")
    queries.write.parquet(src)
    # The stream reads what batch runs read: an index, here with a delta.
    ids = kb.select("id").orderBy("id").limit(9)
    late = kb.join(ids, "id", "left_semi")
    index = build_index(os.path.join(base, "index"), kb.join(ids, "id", "left_anti"), cfg, vocab)
    index = update_index(index, added=late, cfg=cfg)
    assert index.version == 2 and index.parts["n_delta"] == 9
    q, handler = answer_stream(spark, src, kb, os.path.join(base, "index"), out, cfg,
                               checkpoint_location=os.path.join(base, "ckpt"))
    q.awaitTermination(300)
    handler(queries, 0)     # a replayed epoch overwrites itself
    rows = spark.read.parquet(out).collect()
    got = {r.query_id: r.reply for r in rows}
    assert len(rows) == len(got)
    batch, _ = generate(queries, kb, cfg, vocab=vocab)
    want = {r.query_id: r.reply for r in batch.collect()}
    assert got == want and len(got) == 20
    indexed, _ = generate(queries, kb, cfg, index=index)
    assert {r.query_id: r.reply for r in indexed.collect()} == want
