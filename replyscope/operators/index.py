"""A stored index of KB vectors that batch runs and streams share.

A version of the index is a row that names its parts, each in a folder that is
never changed:

- ``rows``: the vectors, a table bucketed by block. Its scan is already dealt by
  block, so a search moves queries to it and never the KB;
- ``delta``: vectors added since, bucketed alike, in the same blocks;
- ``gone``: ids deleted or replaced since, at most ``BROADCAST_ROWS`` of them,
  so that leaving them out is a broadcast anti-join;
- ``clusters``: seeds and bounds, at most ``CELLS`` numbers each;
- ``vocabulary``: the terms the vectors were made with, if they are sparse.

``apply`` writes the changed parts and then the version; an interrupted one
leaves the version before it as it was. Added rows go to the seeds they are most
like and widen the bounds, so a search stays exact. When the changes outgrow the
bound or a share of the rows, ``apply`` writes the rows anew. One writer at a
time; readers keep the version they opened."""
from __future__ import annotations

import io
import os
import uuid
from dataclasses import dataclass, fields

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, Scratch, versions
from .pruned import (CLUSTER_ROWS, KB_BLOCK, QUERY_BLOCK, Clusters, Search, assign, bounds,
                     into_blocks, measure, search, seed_rows, widened)

REBUILD_SHARE = 0.2            # changes, as a share of the rows, that rewrite them
VERSION = ("rows string, delta string, gone string, clusters string, vocabulary string, "
           "kind string, buckets int, kb_block int, cluster_rows int, n_rows bigint, n_delta bigint, n_gone bigint")


def _pack(clusters: Clusters) -> bytes:
    out = io.BytesIO()
    held = {f.name: getattr(clusters, f.name) for f in fields(clusters) if f.name != "kind"}
    np.savez(out, **{k: v for k, v in held.items() if v is not None})
    return out.getvalue()


def _unpack(kind: str, raw: bytes) -> Clusters:
    held = np.load(io.BytesIO(raw))
    return Clusters(kind, **{name: held[name] for name in held.files})


@dataclass
class KbIndex:
    """One version of a stored index."""

    spark: SparkSession
    path: str
    version: int
    parts: dict
    clusters: Clusters

    # ------------------------------------------------------------------ write
    @classmethod
    def create(cls, path: str, kb: DataFrame, kind: str, vocabulary: DataFrame | None = None,
               buckets: int | None = None, kb_block: int = KB_BLOCK,
               cluster_rows: int = CLUSTER_ROWS) -> "KbIndex":
        """Write ``kb(id, vec)`` as version 1, or as the next version of an
        index that is there."""
        spark = kb.sparkSession
        with Scratch(spark) as scratch:
            kb = scratch.table(kb.select("id", "vec"))
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            held = kb.where(F.size("vec") > 0)
            clusters = seed_rows(held, kind, cluster_rows)
            assigned = scratch.table(assign(held, clusters))
            clusters = measure(assigned, clusters, kb_block)
            store = _Store(spark, path)
            parts = {
                "rows": store.bucketed(_blocked(kb, assigned, clusters, buckets), buckets),
                "delta": None, "gone": None, "clusters": store.clusters(clusters),
                "vocabulary": store.plain(vocabulary) if vocabulary is not None else None,
                "kind": kind, "buckets": buckets, "kb_block": kb_block,
                "cluster_rows": cluster_rows, "n_rows": kb.count(), "n_delta": 0, "n_gone": 0}
            return store.commit(parts, clusters)

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> "KbIndex":
        """A version of the index, the last one unless given."""
        known = versions(spark, os.path.join(path, "versions"))
        if not known or (version or known[-1]) not in known:
            raise FileNotFoundError(f"no such index version under {path}")
        version = version or known[-1]
        parts = spark.read.schema(VERSION).parquet(
            os.path.join(path, "versions", str(version))).first().asDict()
        raw = spark.read.parquet(parts["clusters"]).first()["packed"]
        return cls(spark, path, version, parts, _unpack(parts["kind"], raw))

    def apply(self, added: DataFrame | None = None, deleted: DataFrame | None = None,
              rebuild_share: float = REBUILD_SHARE) -> "KbIndex":
        """The next version: without the ids of ``deleted(id)``, with the rows of
        ``added(id, vec)``, which replace rows of the same id."""
        spark, kind, buckets = self.spark, self.parts["kind"], self.parts["buckets"]
        with Scratch(spark) as scratch:
            added = scratch.table(added.select("id", "vec")) if added is not None else \
                spark.createDataFrame([], f"id bigint, vec {kind}")
            lost = added.select("id")
            if deleted is not None:
                lost = lost.union(deleted.select(F.col("id").cast("bigint")))
            lost = scratch.table(lost.distinct())
            kept = self._part("delta").drop("block").join(lost, "id", "left_anti")
            delta = scratch.table(kept.unionByName(added))
            gone = scratch.table(self._gone().union(lost).distinct()
                                 .join(self._stored("rows").select("id"), "id", "left_semi"))
            n_delta, n_gone = delta.count(), gone.count()
            if n_gone > BROADCAST_ROWS or not self.clusters.sizes.any() \
                    or n_delta + n_gone > max(1, rebuild_share * self.parts["n_rows"]):
                live = self._stored("rows").join(gone, "id", "left_anti").select("id", "vec") \
                    .unionByName(delta)
                return KbIndex.create(self.path, live, kind, self.vocabulary(), buckets,
                                      self.parts["kb_block"], self.parts["cluster_rows"])
            store = _Store(spark, self.path)
            assigned = scratch.table(assign(added.where(F.size("vec") > 0), self.clusters))
            sizes = np.zeros(len(self.clusters), dtype=np.int64)
            for r in assigned.groupBy("cluster").count().collect():     # at most one a cluster
                sizes[r[0]] = r[1]
            more = Clusters(kind, self.clusters.seeds, sizes)
            clusters = self.clusters
            if sizes.any():
                bounds(assigned, more)
                clusters = widened(self.clusters, more)
            again = assign(delta.where(F.size("vec") > 0), clusters)
            parts = dict(self.parts, n_delta=n_delta, n_gone=n_gone,
                         delta=store.bucketed(_blocked(delta, again, clusters, buckets), buckets)
                         if n_delta else None,
                         gone=store.plain(gone) if n_gone else None,
                         clusters=store.clusters(clusters))
            return store.commit(parts, clusters)

    # ------------------------------------------------------------------- read
    def _stored(self, part: str) -> DataFrame:
        return _Store(self.spark, self.path).table(self.parts[part], self.parts["kind"],
                                                   self.parts["buckets"])

    def _part(self, part: str) -> DataFrame:
        if self.parts[part]:
            return self._stored(part)
        return self.spark.createDataFrame([], f"block int, id bigint, vec {self.parts['kind']}")

    def _gone(self) -> DataFrame:
        if self.parts["gone"]:
            return self.spark.read.schema("id bigint").parquet(self.parts["gone"])
        return self.spark.createDataFrame([], "id bigint")

    def _live(self) -> list[DataFrame]:
        """The blocks of the version: one frame for the rows, one for the
        delta."""
        rows = self._stored("rows")
        if self.parts["gone"]:
            rows = rows.join(F.broadcast(self._gone()), "id", "left_anti") \
                .select("block", "id", "vec")
        return [rows] + ([self._stored("delta")] if self.parts["delta"] else [])

    def ids(self) -> DataFrame:
        live = [part.select("id") for part in self._live()]
        return live[0] if len(live) == 1 else live[0].union(live[1])

    def vocabulary(self) -> DataFrame | None:
        if not self.parts["vocabulary"]:
            return None
        return self.spark.read.parquet(self.parts["vocabulary"])

    def search(self, queries: DataFrame, k: int, exclude_self: bool = True,
               query_block: int = QUERY_BLOCK) -> Search:
        """The k best live rows for ``queries(row, self_id, vec, ...)``, as
        ``pruned.search`` gives them for all rows."""
        return search(queries, self._live(), self.ids(), self.clusters, k, exclude_self,
                      query_block)


def _blocked(kb: DataFrame, assigned: DataFrame, clusters: Clusters, buckets: int) -> DataFrame:
    """``block, id, vec`` of all rows; those with nothing to compare are dealt
    to blocks of their own, numbered below 0, that no query is sent to."""
    empty = kb.where(F.size("vec") <= 0).select(
        (-1 - F.pmod(F.xxhash64("id"), F.lit(buckets))).cast("int").alias("block"), "id", "vec")
    return into_blocks(assigned, clusters).unionByName(empty)


class _Store:
    """Folders of an index, each written once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self) -> str:
        return os.path.join(self.path, "parts", f"p{uuid.uuid4().hex}")

    def bucketed(self, blocks: DataFrame, buckets: int) -> str:
        """One file per bucket, in block order."""
        folder = self._folder()
        name = os.path.basename(folder)
        (blocks.repartition(buckets, "block").write.format("parquet").option("path", folder)
         .bucketBy(buckets, "block").sortBy("block").saveAsTable(f"replyscope_{name}"))
        return folder

    def table(self, folder: str, kind: str, buckets: int) -> DataFrame:
        """A bucketed folder as a table of this session's catalog."""
        name = f"replyscope_{os.path.basename(folder)}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} (block INT, id BIGINT, vec {kind}) USING parquet "
                           f"CLUSTERED BY (block) SORTED BY (block) INTO {buckets} BUCKETS "
                           f"LOCATION '{folder}'")
        return self.spark.table(name)

    def plain(self, df: DataFrame) -> str:
        folder = self._folder()
        df.write.parquet(folder)
        return folder

    def clusters(self, clusters: Clusters) -> str:
        return self.plain(self.spark.createDataFrame([(_pack(clusters),)], "packed binary"))

    def commit(self, parts: dict, clusters: Clusters) -> KbIndex:
        folder = os.path.join(self.path, "versions")
        version = max(versions(self.spark, folder), default=0) + 1
        names = [c.split()[0] for c in VERSION.split(", ")]
        (self.spark.createDataFrame([tuple(parts[n] for n in names)], VERSION).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(folder, str(version))))
        return KbIndex(self.spark, self.path, version, dict(parts), clusters)
