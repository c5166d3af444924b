"""Tables written by hashed key with Spark's own buckets, so that copies are joined again and again without a shuffle.

Both copies are written with the same keys and number of buckets: bucket i of one meets bucket i of the other, in
key order. Rows are dealt out by the same hash before they are written, so a bucket is one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Save `df` as the table `name` with its files under `path`; rows are sorted by key in each bucket."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).mode("overwrite").saveAsTable(name)


def joined(spark: SparkSession, left: str, right: str, keys: Sequence[str], how: str = "full") -> DataFrame:
    """The tables joined bucket by bucket; column names other than the keys must differ, the keys come out once."""
    return spark.table(left).hint("merge").join(spark.table(right), list(keys), how)

