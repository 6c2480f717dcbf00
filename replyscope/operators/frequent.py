"""V3 in bounded memory: the most frequent terms without counting all others.

Every task keeps a summary of at most ``COUNTERS`` terms (a mergeable
Misra-Gries summary: when it overflows, the count of the first term that doesn't
fit is taken off all of them, and what falls to 0 leaves). Its counts are too low
by at most what was taken off, so with ``error`` the sum over all tasks

    count <= true count <= count + error,

and a term in no summary has a true count of at most ``error``. Terms that may
be among the N most frequent are counted again, exactly. If the N-th of them is
above ``error``, no other term can come before it and the result is complete;
otherwise all terms are counted. What is shuffled are the summaries and the
candidates, not every distinct bigram of the corpus."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .packed import Vocabulary

COUNTERS = 1 << 17             # terms of a task's summary
CANDIDATES = 1 << 18           # terms that are broadcast for the second count
BATCH_TERMS = 1 << 18          # terms added to a summary at once


def _entries(batch: pa.RecordBatch):
    """Slices of the terms and counts of a batch of counted texts."""
    flat = batch.column(0).flatten()
    for start in range(0, len(flat), BATCH_TERMS):
        part = flat.slice(start, BATCH_TERMS)
        yield part.field(0), part.field(1)


class Summary:
    """Counts per term, ``df`` the number of texts, and the ``error`` so far."""

    def __init__(self, counters: int):
        self.counters, self.error = counters, 0
        self.table = pa.table({"term": pa.array([], pa.string()), "tf": pa.array([], pa.int64()),
                               "df": pa.array([], pa.int64())})

    def add(self, terms: pa.Array, counts: pa.Array) -> None:
        more = pa.table({"term": terms.cast(pa.string()), "tf": counts.cast(pa.int64()),
                         "df": pa.array(np.ones(len(terms), dtype=np.int64))})
        both = pa.concat_tables([self.table, more]).group_by("term") \
            .aggregate([("tf", "sum"), ("df", "sum")])
        self.table = pa.table({"term": both["term"], "tf": both["tf_sum"], "df": both["df_sum"]})
        if self.table.num_rows > self.counters:
            tf = self.table["tf"].to_numpy()
            off = int(-np.partition(-tf, self.counters)[self.counters])
            self.error += off
            left = tf - off
            kept = self.table.set_column(1, "tf", pa.array(left))
            self.table = kept.filter(pa.array(left > 0))


def _summaries(counts: DataFrame, counters: int) -> DataFrame:
    """``term, tf, df`` of every task's summary, and its error in a row without
    a term."""
    def run(batches):
        held = Summary(counters)
        for batch in batches:
            for terms, cnt in _entries(batch):
                held.add(terms, cnt)
        for part in held.table.to_batches():
            yield part
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.string()), pa.array([held.error], pa.int64()),
             pa.array([0], pa.int64())], ["term", "tf", "df"])

    return counts.select("tc").mapInArrow(run, "term string, tf bigint, df bigint")


def _recounted(counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """``term, tf, df`` of the candidates, exactly."""
    table = candidates.select("term", F.lit(0.0).alias("idf")).toArrow()    # <= CANDIDATES rows
    shared = counts.sparkSession.sparkContext.broadcast(Vocabulary(table))

    def run(batches):
        known = shared.value
        tf, df = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for terms, cnt in _entries(batch):
                at = known.number(terms)
                hit = at >= 0
                np.add.at(tf, at[hit], cnt.to_numpy(zero_copy_only=False)[hit])
                df += np.bincount(at[hit], minlength=len(known))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [known.terms.take(pa.array(some)), pa.array(tf[some]), pa.array(df[some])],
            ["term", "tf", "df"])

    return (counts.select("tc").mapInArrow(run, "term string, tf bigint, df bigint")
            .groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def _nth(stats: DataFrame, n: int) -> int | None:
    """The n-th highest ``tf``, if there are so many terms."""
    found = stats.orderBy(F.desc("tf")).limit(n).agg(F.count(F.lit(1)), F.min("tf")).first()
    return found[1] if found[0] == n else None


def frequent_terms(counts: DataFrame, n: int, most_texts: float | None = None,
                   counters: int = COUNTERS) -> tuple[DataFrame, str]:
    """``term, tf, df`` with all of the ``n`` terms of highest ``tf`` among them,
    of ``counts(tc)``, texts with their distinct terms and counts. Terms in more
    than ``most_texts`` texts don't count. Also says how it was found:
    ``summaries`` (no summary overflowed, so they are exact), ``candidates`` or
    ``all``."""
    scratch = Scratch.of(counts.sparkSession)
    summaries = scratch.table(_summaries(counts, counters))
    error = summaries.where("term is null").agg(F.sum("tf")).first()[0] or 0
    merged = summaries.where("term is not null").groupBy("term") \
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    few = F.lit(True) if most_texts is None else F.col("df") <= F.lit(float(most_texts))
    if error == 0:
        return merged.where(few), "summaries"
    merged = scratch.table(merged)
    # Terms that surely stay below the text limit give the bar to reach.
    sure = merged if most_texts is None else merged.where(F.col("df") + error <= float(most_texts))
    bar = _nth(sure, n)
    candidates = merged if bar is None else merged.where(F.col("tf") + error >= bar)
    if candidates.limit(CANDIDATES + 1).count() <= CANDIDATES:
        exact = scratch.table(_recounted(counts, candidates).where(few))
        reached = _nth(exact, n)
        if reached is not None and reached > error:
            return exact, "candidates"
    every = counts.select(F.inline_outer("tc")).where(F.col("term").isNotNull())
    return every.groupBy("term").agg(
        F.sum("cnt").cast("bigint").alias("tf"),
        F.count(F.lit(1)).cast("bigint").alias("df")).where(few), "all"
