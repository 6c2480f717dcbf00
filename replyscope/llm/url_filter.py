"""URL filter: a trie over reversed host labels, then path segments, holds
allow and block rules; the longest rule that fits a url decides.

A rule is ``(verdict, host, path)``. It fits a url whose host is the rule's or
a subdomain of it and whose path starts with the rule's path (as text, so the
last segment may be a part of the url's segment). The longest rule wins: most
host labels first, then the longest path; of an allow and a block entry for
the same host and path the block entry holds. A url without a fitting rule
gets ``default``.

Up to ``MAX_TRIE_RULES`` rules the trie is broadcast (at most that many paths,
each at most ``MAX_RULE_CHARS`` long). A larger list is joined instead: each
url meets the rules of its own host suffixes, and the longest is kept."""
from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, only

MAX_TRIE_RULES = 200_000
MAX_RULE_CHARS = 2_000

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


class Trie:
    """Nodes are dicts: host labels from the last to the first, then path
    segments. A host node keeps its path root under ``None``; a path node keeps
    under ``None`` the rules that end inside a following segment."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            if ends.get(last, ("",))[0] != "block":
                ends[last] = (verdict, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        found = None
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            paths = node.get(None)
            if paths is not None:
                found = self._path(paths, path) or found
        return found

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        found = None
        for segment in path.split("/"):
            ends = node.get(None)
            if ends:
                for cut in range(len(segment), -1, -1):
                    hit = ends.get(segment[:cut])
                    if hit:
                        found = hit
                        break
            node = node.get(segment)
            if node is None:
                break
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def filter_urls(df: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]] = RULES,
                key: str = "page_id", url: str = "url", default: str = "allow",
                max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """One row per input row: key, ``host``, ``path``, ``rule`` (null if none
    fits), ``verdict``. A null or odd url has an empty host and path and gets
    the default; repeated rows are judged each; an empty table gives none."""
    spark = df.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    rules = only(rules, verdict="string", host="string", path="string")
    head = rules.limit(max_trie_rules + 1).collect()
    bad = [r for r in head if r.verdict not in ("allow", "block") or not r.host or r.path is None
           or len(r.host) + len(r.path) > MAX_RULE_CHARS]
    if bad:
        raise ValueError(f"not a rule: {tuple(bad[0])}")
    urls = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").cast("string").alias(url))
    if len(head) > max_trie_rules:
        return _joined(urls, rules, key, url, default)
    trie = spark.sparkContext.broadcast(Trie(tuple(r) for r in head))
    schema = T.StructType([urls.schema[key]])
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")

    def judge(batch: pa.RecordBatch, _):
        tree = trie.value
        split = [split_url(u) for u in batch.column(1).to_pylist()]
        hits = [tree.find(h, p) if h else None for h, p in split]
        return {key: batch.column(0), "host": [h for h, _ in split], "path": [p for _, p in split],
                "rule": [h[1] if h else None for h in hits],
                "verdict": [h[0] if h else default for h in hits]}

    return map_batches(urls, judge, schema, text=url)


def _joined(urls: DataFrame, rules: DataFrame, key: str, url: str, default: str) -> DataFrame:
    """For rule lists too long to broadcast. Urls are judged per distinct
    (host, path), so a hot host meets its rules once per path, and each host
    suffix joins the rules of exactly that host."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)) \
        .otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = urls.withColumns({"host": F.coalesce(host, F.lit("")),
                              "path": F.coalesce(F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1),
                                                 F.lit(""))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, -i, i), "."))
    best = (named.where("host != ''").select("host", "path").distinct()
            .withColumn("suffix", F.explode(suffixes))
            .join(rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"),
                               F.col("verdict").alias("is")), "suffix")
            .where(F.expr("startswith(path, start)"))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.size(F.split("suffix", r"\.")).alias("a"),
                                F.length("start").alias("b"), (F.col("is") == "block").alias("c"),
                                F.concat("suffix", "start").alias("rule"),
                                F.col("is"))).alias("hit")))
    return (named.join(best, ["host", "path"], "left")
            .select(key, "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.is", F.lit(default)).alias("verdict")))
