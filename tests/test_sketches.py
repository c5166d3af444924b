"""Stored summaries against exact answers."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import keyed, ordered, sketches

P = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """Sixty thousand rows over twelve days: skewed, with many equal values, nulls and NaN; a third in one group."""
    i = F.col("id")
    value = F.when(i % 50 == 0, F.lit(None)).when(i % 77 == 0, F.lit(float("nan"))).when(i % 3 == 0, F.lit(7.0)).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(9973)), F.lit(2.0)))
    return spark.range(60_000).select("id", F.when(i % 3 == 1, "hot").otherwise(F.concat(F.lit("g"), i % 4)).alias("g"), (i % 12).cast("int").alias("d"), value.alias("v"))


def clean(df):
    return df.where("v is not null and not isnan(v)")


def test_merged_quantiles_are_within_the_stated_rank_error(spark, rows):
    parts = sketches.quantile_sketches(rows, ["g", "d"], "v", 200)
    found = sketches.quantiles(sketches.merged_sketches(parts, ["g"], 200), ["g"], P)
    off = sketches.off_by(clean(rows), ["g"], "v", found.drop("n")).collect()
    assert len(off) == 5 * len(P) and max(r.off for r in off) <= 1.5 * sketches.rank_error(200)
    sizes = {r.g: r.n for r in clean(rows).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert {r.g: r.n for r in found.select("g", "n").distinct().collect()} == sizes
    # exact quantiles are off by nothing
    exact = ordered.exact_quantiles(clean(rows), ["g"], "v", [0.25, 0.5]).select("g", "probability", "quantile")
    assert max(r.off for r in sketches.off_by(clean(rows), ["g"], "v", exact).collect()) < 1e-3
    assert parts.select(F.max(F.octet_length("sketch"))).first()[0] < 20_000


def test_a_new_day_does_not_read_old_days(spark, rows, tmp_path):
    store = sketches.SketchStore(spark, str(tmp_path), ["g"], "v")
    for day in range(3):
        store.add(rows.where(F.col("d") == day), f"2024-01-0{day + 1}")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("day=2024-01-0[12]/*.parquet")}
    store.add(rows.where("d = 5"), "2024-01-03")  # that day again, with other rows
    assert before == {p: p.stat().st_mtime_ns for p in tmp_path.rglob("day=2024-01-0[12]/*.parquet")}
    sizes = lambda df: {r.g: r.n for r in df.select("g", "n").collect()}
    want = lambda test: {r.g: r.n for r in clean(rows).where(test).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert sizes(store.sketches()) == want("d in (0, 1, 5)")
    assert sizes(store.sketches("2024-01-02")) == want("d in (1, 5)") and sizes(store.sketches(None, "2024-01-01")) == want("d = 0")


@pytest.mark.parametrize("lg", [8, 12])
def test_overlap_of_sites(spark, lg):
    """Two sites with known shares; days are united before they are compared."""
    days = spark.range(30_000).select((F.col("id") % 5).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")
    one, other = days.where("id < 24000"), days.where("id >= 6000").unionByName(days.where("id >= 20000"))
    both = [sketches.united(sketches.set_sketches(side, ["day"], "h", lg), [], lg).withColumnRenamed("sketch", n) for side, n in ((one, "a"), (other, "b"))]
    found = both[0].crossJoin(both[1]).select(*sketches.overlap(F.col("a"), F.col("b"), lg)).withColumn("error", sketches.overlap_error(F.col("either"), lg)).first()
    for name, n in (("both", 18_000), ("first_only", 6000), ("second_only", 6000), ("either", 30_000)):
        assert abs(found[name] - n) <= 1.5 * found.error, name
    few = spark.createDataFrame([(c,) for c in "aabbcd"], "h string")
    assert sketches.set_sketches(few, [], "h").select(F.theta_sketch_estimate("sketch")).first()[0] == 4


@pytest.mark.parametrize("k", [1, 3, 1000])
def test_bottom_k(spark, rows, k):
    copy = rows.repartition(7).orderBy(F.desc("id"))  # the other site, in another order
    picked = [Counter((r.g, r.id) for r in keyed.bottom_k(df, ["g"], ["id"], k).collect()) for df in (rows, copy)]
    assert picked[0] == picked[1]
    sizes = {r.g: r["count"] for r in rows.groupBy("g").count().collect()}
    assert Counter(g for g, _ in picked[0]) == {g: min(k, n) for g, n in sizes.items()}
    plan = keyed.bottom_k(rows, ["g"], ["id"], k)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1 or k > 100  # cut in each task, before the shuffle
