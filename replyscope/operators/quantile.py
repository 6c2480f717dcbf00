"""A1 for any values: exact medians per group in bounded memory.

``F.median`` keeps a counter per distinct value of a group. Here a sketch per
group (``percentile_approx`` on a grid, merged map-side) brackets the middle, the
rows below and inside the bracket are counted exactly, and the bracket is
narrowed again until it holds few distinct values in every group. Those are
counted per value, so that a value that half of the rows share is one row, and
the middle pair is read off their running counts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, small

GRID = 200                     # steps of a sketch's grid
ACCURACY = 10_000              # of the sketch: a rank is off by 1 / ACCURACY at most
FEW_VALUES = 100_000           # distinct values of a group that are counted one by one
MOST_PASSES = 20


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)],
                  F.lit(True))


def exact_medians(df: DataFrame, value: str, groups: list[str],
                  few_values: int = FEW_VALUES) -> DataFrame:
    """``groups..., n, median`` with the mean of the middle pair, as a double.
    Null and NaN values don't count; a group without others has a null
    median. Null is a group of its own."""
    spark = df.sparkSession
    scratch = Scratch.of(spark)
    v = F.col(value).cast("double")
    rows = df.select(*[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)],
                     F.when(~F.isnan(v), v).alias("v"))
    keys = [f"g{i}" for i in range(len(groups))]
    held = [f"s{i}" for i in range(len(groups))]

    def inside(state: DataFrame, n_groups: int) -> DataFrame:
        """The rows within their group's bracket, with its state."""
        side = state.select(*[F.col(k).alias(h) for k, h in zip(keys, held)], "n", "low", "high",
                            "below")
        side = F.broadcast(side) if small(n_groups) else side
        return rows.join(side, _same(keys, held)).where(F.col("v").between(
            F.col("low"), F.col("high")))

    state = scratch.table(rows.groupBy(*keys).agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.approx_count_distinct("v").alias("values")).withColumn("below", F.lit(0).cast("bigint")))
    n_groups = state.count()
    first, second = (F.floor((F.col("n") - 1) / 2) - F.col("below"),
                     F.floor(F.col("n") / 2) - F.col("below"))
    for _ in range(MOST_PASSES):
        if state.where(F.col("values") > few_values).isEmpty():
            break
        grid = F.percentile_approx("v", [i / GRID for i in range(GRID + 1)], ACCURACY)
        marks = inside(state, n_groups).groupBy(*keys, "n", "low", "high", "below").agg(
            F.count("v").alias("m"), grid.alias("grid"))

        def mark(rank: Column, steps: int) -> Column:
            at = F.floor(rank * GRID / F.col("m")).cast("int") + steps
            return F.element_at("grid", F.least(F.greatest(at, F.lit(0)), F.lit(GRID)) + 1)

        tighter = scratch.table(marks.select(
            *keys, "n", "below", F.col("low").alias("old_low"), F.col("high").alias("old_high"),
            F.when(first * GRID / F.col("m") < 2, F.col("low")).otherwise(mark(first, -1))
            .alias("low"),
            F.when(second * GRID / F.col("m") > GRID - 3, F.col("high")).otherwise(mark(second, 2))
            .alias("high")))
        side = tighter.select(*[F.col(k).alias(h) for k, h in zip(keys, held)], "n", "low", "high",
                              "below", "old_low", "old_high")
        side = F.broadcast(side) if small(n_groups) else side
        within = F.col("v").between(F.col("low"), F.col("high"))
        counted = (rows.join(side, _same(keys, held))
                   .where(F.col("v").between(F.col("old_low"), F.col("old_high")))
                   .groupBy(*keys, "n", "low", "high", "below", "old_low", "old_high").agg(
                       F.count_if(F.col("v") < F.col("low")).alias("less"),
                       F.count_if(within).alias("m"),
                       F.approx_count_distinct(F.when(within, F.col("v"))).alias("values")))
        # The exact counts tell whether the middle pair is in the new bracket.
        good = (first >= F.col("less")) & (second < F.col("less") + F.col("m"))
        narrowed = counted.select(
            *keys, "n", F.when(good, F.col("low")).otherwise(F.col("old_low")).alias("low"),
            F.when(good, F.col("high")).otherwise(F.col("old_high")).alias("high"),
            F.when(good, F.col("values")).otherwise(F.lit(few_values + 1)).alias("values"),
            (F.col("below") + F.when(good, F.col("less")).otherwise(0)).alias("below"))
        none = state.where("n = 0").select(*narrowed.columns)
        state = scratch.table(narrowed.unionByName(none))
    values = inside(state, n_groups).groupBy(*keys, "n", "below", "v").agg(
        F.count(F.lit(1)).alias("times"))
    # At most few_values rows a group (after MOST_PASSES as many as are left).
    run = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = values.withColumn("upto", F.sum("times").over(run))
    found = upto.groupBy(*keys).agg(
        F.min(F.when(F.col("upto") > first, F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") > second, F.col("v"))).alias("b"))
    side = found.select(*[F.col(k).alias(h) for k, h in zip(keys, held)],
                        (F.col("a") / 2 + F.col("b") / 2).alias("half"), "a", "b")
    return state.join(side, _same(keys, held), "left").select(
        *[F.col(k).alias(g) for k, g in zip(keys, groups)], "n",
        F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("half")).alias("median"))
