"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For each
of ``SAMPLES`` samples every term draws, from its own hash, two gamma(2, 1)
variables and a shift; they place its weight on a logarithmic grid, and the
term whose grid point gives the smallest value is the sample. Two texts have
the same sample with a probability equal to their generalised Jaccard
similarity (sum of the smaller weights over sum of the larger ones). The
smallest value itself is a function of the term and its grid point, so its
bits stand for the sample and a plain ``min`` per sample suffices.

Only DataFrame functions are used. Texts meet their successor in buckets of a
range of ids, and everything after that stays in those buckets: words are
counted and sampled without another shuffle of words."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import only

SAMPLES = 32
COLUMNS = 8              # samples worked out in one row; SAMPLES / COLUMNS rows per term
DIGITS = 4               # hexadecimal digits kept of each sample
IDS_PER_BUCKET = 500
MAX_BOUNDS = 1_000
RANGE = float(2 ** 32)


def _uniforms(h: Column) -> tuple[Column, Column]:
    """Two numbers in (0, 1) from the halves of a 64-bit hash."""
    return ((F.shiftrightunsigned(h, 32).cast("double") + .5) / RANGE,
            (h.bitwiseAND(0xFFFFFFFF).cast("double") + .5) / RANGE)


def _value(term: Column, log_weight: Column, sample: Column) -> Column:
    """The logarithm of the value to minimise for one sample of one term."""
    u1, u2 = _uniforms(F.xxhash64(term, sample))
    u3, u4 = _uniforms(F.xxhash64(sample, term))
    beta, _ = _uniforms(F.xxhash64(term, sample, F.lit(1)))
    r = -F.log(u1 * u2)
    step = F.floor(log_weight / r + beta)
    return F.log(-F.log(u3 * u4)) - r * (step - beta) - r


def _signatures(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` of each text, all rows of a key in one
    partition already."""
    weighted = (texts.select(*keys, F.explode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("word"))
                .where("word != ''")
                .select(*keys, F.xxhash64("word").alias("term"))
                .groupBy(*keys, "term").agg(F.log(F.count("*").cast("double")).alias("w")))
    parts = weighted.withColumn("part", F.explode(F.array(
        *[F.lit(i * COLUMNS) for i in range(SAMPLES // COLUMNS)])))
    least = parts.groupBy(*keys, "part").agg(*[
        F.min(_value(F.col("term"), F.col("w"), F.col("part") + i)).alias(f"s{i}")
        for i in range(COLUMNS)])
    digits = F.concat(*[F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(f"s{i}"), F.lit(16 ** DIGITS)))),
                               DIGITS, "0") for i in range(COLUMNS)])
    return (least.select(*keys, F.struct("part", digits.alias("digits")).alias("at"))
            .groupBy(*keys).agg(F.sort_array(F.collect_list("at")).alias("all"))
            .select(*keys, F.array_join("all.digits", "").alias("fingerprint")))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike (1), a text
    without words and one with words are not (0)."""
    def sample(c, i):
        return F.substring(c, i * DIGITS + 1, DIGITS)

    same = sum((F.when(sample(a, i) == sample(b, i), 1).otherwise(0) for i in range(SAMPLES)),
               F.lit(0))
    return F.when((a == "") | (b == ""), F.when(a == b, 1.0).otherwise(0.0)) \
        .otherwise(same / float(SAMPLES))


def _bucketed(docs: DataFrame, ids_per_bucket: int) -> DataFrame:
    """Rows with ``bucket``, which rises as ids fall; rows without an id come
    last. Up to ``MAX_BOUNDS`` quantiles of the ids part the rows, and each part
    is cut evenly by id into as many buckets as its rows need."""
    total = docs.count()
    parts = max(1, min(MAX_BOUNDS, total // ids_per_bucket))
    shares = [i / parts for i in range(parts + 1)]
    bounds = docs.select(F.percentile_approx("doc_id", shares, 10 * MAX_BOUNDS)).first()[0]
    if not bounds:      # no ids at all
        return docs.withColumn("bucket", F.lit(0).cast("bigint"))
    bounds = sorted(set(bounds))
    cuts = max(1, total // (parts * ids_per_bucket))
    held = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    above = F.size(F.filter(held, lambda b: b > F.col("doc_id")))
    low = F.element_at(held, F.greatest(F.lit(len(bounds)) - above, F.lit(1)))
    high = F.element_at(held, F.greatest(F.least(F.lit(len(bounds)) - above + 1,
                                                 F.lit(len(bounds))), F.lit(1)))
    share = (high - F.col("doc_id")).cast("double") / F.greatest(high - low, F.lit(1))
    cut = F.least(F.greatest(F.floor(share * cuts), F.lit(0)), F.lit(cuts - 1))
    return docs.withColumn("bucket", F.when(F.col("doc_id").isNull(),
                                            F.lit((len(bounds) + 2) * cuts))
                           .otherwise(above * F.lit(cuts) + cut).cast("bigint"))


def fingerprints(df: DataFrame, scratch: Scratch | None = None,
                 ids_per_bucket: int = IDS_PER_BUCKET) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next smaller id (ties by text, rows
    without an id last), after the last one the first; a lone document is its
    own next. The edited text has its last third replaced by the start of the
    next document. A null text counts as empty; a text without words has an
    empty fingerprint; repeated rows are each other's next in turn; an empty
    table gives no rows."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = only(df, doc_id="bigint", text="string") \
        .withColumn("text", F.coalesce("text", F.lit("")))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    ranked = _bucketed(docs, ids_per_bucket).select(
        "*", F.row_number().over(order).alias("rank"), F.lead("text").over(order).alias("after"))
    heads = scratch.table(ranked.where("rank = 1").select("bucket", "text"))
    around = Window.orderBy("bucket")       # one short row per bucket
    following = (heads.select("bucket")
                 .select("bucket", F.lead("bucket").over(around).alias("then"),
                         F.min("bucket").over(around).alias("start"))
                 .select("bucket", F.coalesce("then", "start").alias("then")))
    then = following.join(heads.select(F.col("bucket").alias("then"), F.col("text").alias("head")),
                          "then")
    cut = F.floor(F.char_length("text") / 3).cast("int")
    pairs = (ranked.join(then, "bucket", "left")
             .withColumn("following", F.coalesce("after", "head"))
             .withColumn("edited", F.concat(
                 F.expr("substring(text, 1, char_length(text) - "
                        "cast(floor(char_length(text) / 3) as int))"),
                 F.substring("following", F.lit(1), cut))))
    keys = ["bucket", "rank"]
    both = pairs.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("edit"), F.col("text")),
        F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text")))).alias("of")) \
        .select(*keys, "of.edit", "of.text")

    def of(edit: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("edit") == edit, F.col("fingerprint"))), F.lit(""))

    signed = scratch.table(_signatures(both, [*keys, "edit"]).groupBy(*keys).agg(
        of(0).alias("fingerprint"), of(1).alias("edited_fingerprint")))
    rows = scratch.table(pairs.select(
        *keys, "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.when(F.col("after").isNull(), F.col("then")).otherwise(F.col("bucket")).alias("to"),
        F.when(F.col("after").isNull(), 1).otherwise(F.col("rank") + 1).alias("to_rank")))
    found = rows.join(signed, keys, "left").na.fill("", ["fingerprint", "edited_fingerprint"])
    following = signed.select(F.col("bucket").alias("to"), F.col("rank").alias("to_rank"),
                              F.col("fingerprint").alias("next_fingerprint"))
    out = found.join(following, ["to", "to_rank"], "left").na.fill("", ["next_fingerprint"])
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
