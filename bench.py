"""Benchmark: run the headline queries at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full with Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver), three times in turn; its median
time counts. A tiny warm-up query runs first so JVM start-up is not charged to
the first query."""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from replyscope.plans import queries as Q  # noqa: E402
from replyscope.plans.pipeline import run  # noqa: E402
from replyscope.session import Scratch, build_session  # noqa: E402
from replyscope.sources.reports import summary_lines  # noqa: E402

ROUNDS = 3

HEADLINE = (
    "ticket_pipeline",        # split -> TF-IDF -> top-3 -> reply -> scores -> summaries
    "evaluate_pairs",         # all metrics over every conversation pair
    "topk_self_excluded",     # sparse exact top-k, every pair against every pair
    "topk_dense",             # dense exact top-k over the embeddings
    "tfidf_vectors",          # TF-IDF fit + vectors over all documents
    "token_alignment_prf",    # word-level alignment P/R/F1
    "rouge_l",                # bit-parallel LCS over all pairs
)


def ticket_pipeline(spark, sf):
    """The full run over the given tickets (the pairs of ``conversations``):
    split, vocabulary fit, retrieval for the holdout, replies, all metrics, and
    the summary text, which reads scores, summary, component means and meta."""
    r = run(Q.given(spark, sf))
    return summary_lines(r.summary, r.components, r.meta)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # One machine: its temporary folder is shared by all of the run.
    ckpt = tempfile.mkdtemp(prefix="replyscope-bench-ckpt-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          conf={"spark.driver.memory": "16g", "spark.checkpoint.dir": ckpt})
    spark.range(1000).selectExpr("sum(id)").collect()
    Q.q_pairs_from_conversations(spark, sf).write.format("noop").mode("overwrite").save()
    taken: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(ROUNDS):
        for name in HEADLINE:
            fn = ticket_pipeline if name == "ticket_pipeline" else Q.QUERIES[name]
            t0 = time.time()
            with Scratch(spark):
                fn(spark, sf).write.format("noop").mode("overwrite").save()
            taken[name].append(time.time() - t0)
    timings = {name: round(median(t), 3) for name, t in taken.items()}
    total = round(sum(timings.values()), 3)
    sf_name = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf_name}))
    spark.stop()


if __name__ == "__main__":
    main()
