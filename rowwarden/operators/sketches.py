"""Summaries that are stored per partition value and merged, so long histories are compared without being read again.

Quantiles: KLL sketches, one per group, some kilobytes whatever the number of rows. The rank of a quantile read from a sketch, or
from the merge of any number of them, is off by at most `rank_error(k)` of the rows (in 99 of 100 cases).

Sets: theta sketches of distinct values, which can be united, intersected and taken from each other. So how many
digests two sites share, and how many only one has, comes from two sketches and no digest is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUANTILE_K = 800
THETA_LG = 14


def rank_error(k: int = QUANTILE_K) -> float:
    """Rank error of KLL sketches of size k, as their documentation states it."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, groups: Sequence[str], value: str, k: int = QUANTILE_K) -> DataFrame:
    """(groups, n, sketch) of the values that are not null; partial sketches are merged on the map side."""
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(*groups, number.alias("_v"))
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, groups: Sequence[str], k: int = QUANTILE_K) -> DataFrame:
    """Sketches put together over everything but the groups."""
    return sketches.groupBy(*groups).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, groups: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(groups, n, probability, quantile)."""
    pairs = F.array(*[F.struct(F.lit(p).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("quantile")) for p in probabilities])
    return sketches.select(*groups, "n", F.inline(pairs))


def off_by(df: DataFrame, groups: Sequence[str], value: str, found: DataFrame) -> DataFrame:
    """`found` (groups, probability, quantile) with `off`: how far the rank of each quantile is from the one asked for, in shares of the rows.

    Equal values span a range of ranks; a rank inside it is not off.
    """
    tagged = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    asked = found.groupBy(*groups).agg(F.collect_list(F.struct("probability", "quantile")).alias("_q"))  # the few that are asked
    met = tagged.join(F.broadcast(asked), list(groups)).select(*groups, "_v", F.inline("_q"))
    share = lambda test: F.avg(test.cast("double"))
    ranks = met.groupBy(*groups, "probability", "quantile").agg(share(F.col("_v") < F.col("quantile")).alias("_low"), share(F.col("_v") <= F.col("quantile")).alias("_high"))
    p = F.col("probability")
    return ranks.withColumn("off", F.greatest(F.col("_low") - p, p - F.col("_high"), F.lit(0.0))).drop("_low", "_high")


class SketchStore:
    """Sketches of a table kept one folder per day; a new day is added without a look at the others."""

    def __init__(self, spark: SparkSession, root: str, groups: Sequence[str], value: str, k: int = QUANTILE_K):
        self.spark, self.root, self.groups, self.value, self.k = spark, root, list(groups), value, k

    def add(self, rows: DataFrame, day: str) -> None:
        """Bring in the rows of a day; a day that is added again replaces itself."""
        made = quantile_sketches(rows, self.groups, self.value, self.k)
        made.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/day={day}")

    def sketches(self, first: str | None = None, last: str | None = None) -> DataFrame:
        kept = self.spark.read.parquet(self.root)
        for bound, test in ((first, lambda d: F.col("day") >= d), (last, lambda d: F.col("day") <= d)):
            kept = kept if bound is None else kept.where(test(F.lit(bound).cast("date")))
        return merged_sketches(kept, self.groups, self.k)


def set_sketches(df: DataFrame, groups: Sequence[str], value: str, lg: int = THETA_LG) -> DataFrame:
    """(groups, sketch) of the distinct values; 2**lg values are held exactly, more are estimated."""
    return df.where(F.col(value).isNotNull()).groupBy(*groups).agg(F.theta_sketch_agg(value, lg).alias("sketch"))


def united(sketches: DataFrame, groups: Sequence[str], lg: int = THETA_LG) -> DataFrame:
    return sketches.groupBy(*groups).agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def overlap(a: Column, b: Column, lg: int = THETA_LG) -> list[Column]:
    """Estimates from two sketches: values of both, of the first alone, of the second alone, and of either."""
    size = F.theta_sketch_estimate
    return [
        size(F.theta_intersection(a, b)).alias("both"), size(F.theta_difference(a, b)).alias("first_only"),
        size(F.theta_difference(b, a)).alias("second_only"), size(F.theta_union(a, b, lg)).alias("either"),
    ]


def overlap_error(either: Column, lg: int = THETA_LG) -> Column:
    """How far each of the estimates may be off (two standard errors), from the size of the union; 0 while it is held exactly."""
    return F.when(either < 2**lg, F.lit(0.0)).otherwise(2 * either / 2 ** (lg / 2))
