"""Incoming emails as a stream: retrieve cases and produce a grounded reply
for each new email with the batch operators, one micro-batch at a time.

Stream-static and stateless, so no watermark is needed. The KB is a stored index
(``operators.index``), the same that batch runs read: every micro-batch opens its
last version, so tickets added meanwhile are found and nothing is held in
executor memory between batches. Each epoch is written to a folder of its own and
overwrites it, so a replayed micro-batch leaves no second copy."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import RunConfig
from ..operators.dense import Encoder
from ..operators.index import KbIndex
from ..plans.generate import generate
from ..session import Scratch, checkpoint_dir

INCOMING_SCHEMA = "query_id BIGINT, query_email STRING"


class IncomingReplies:
    """``foreachBatch`` handler: every micro-batch of ``(query_id,
    query_email)`` is answered against the index and written under ``out_path``
    as Parquet (``query_id, query_email, reply, retrieved``), partitioned by
    ``epoch_id``. ``kb`` has the texts of the tickets."""

    def __init__(self, kb: DataFrame, index_path: str, out_path: str,
                 cfg: RunConfig = RunConfig(), encoder: Encoder | None = None):
        self.cfg, self.encoder = cfg, encoder
        self.kb = kb.select("id", "customer_email", "support_reply", "category")
        self.index_path, self.out_path = index_path, out_path

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        with Scratch(spark):        # the batch's tables go when its replies are written
            index = KbIndex.open(spark, self.index_path)
            out, _ = generate(batch.select("query_id", "query_email"), self.kb, self.cfg,
                              encoder=self.encoder, index=index)
            out.select("query_id", "query_email", "reply", "retrieved") \
                .write.mode("overwrite").parquet(f"{self.out_path}/epoch_id={epoch_id}")


def answer_stream(spark: SparkSession, source_dir: str, kb: DataFrame, index_path: str,
                  out_path: str, cfg: RunConfig = RunConfig(), available_now: bool = True,
                  checkpoint_location: str | None = None) -> tuple[StreamingQuery, IncomingReplies]:
    """Start the stream over Parquet files of incoming emails in
    ``source_dir``. The stream's own checkpoint goes under the shared
    checkpoint folder unless given. ``available_now`` processes what is
    there and stops (batch-style runs and tests)."""
    handler = IncomingReplies(kb, index_path, out_path, cfg)
    location = checkpoint_location or os.path.join(checkpoint_dir(spark), "incoming-stream")
    stream = spark.readStream.schema(INCOMING_SCHEMA).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(), handler
