"""Quality counters, ratios and alerts. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def count_by(df: DataFrame, column: str, alias: str = "total") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias))


def _window(df: DataFrame, moment: str, duration: str) -> Column:
    """The tumbling window of a row as a struct, null where the time is null.

    `window()` itself filters rows without a time out of the whole plan. A stream needs it for its
    watermark, and has no place for such rows.
    """
    if df.isStreaming:
        return F.window(moment, duration)
    number, unit = duration.split()
    size = int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.lower().rstrip("s")]
    at = F.unix_seconds(F.col(moment).cast("timestamp"))
    start = at - F.pmod(at, F.lit(size))
    edge = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return F.when(at.isNotNull(), F.struct(edge(start).alias("start"), edge(start + size).alias("end")))


def tumbling(df: DataFrame, moment: str, duration: str, aggregates: Sequence[Column], tags: dict | None = None) -> DataFrame:
    """Aggregates per time window, tagged with constant columns; rows without a time have a null window."""
    counted = df.groupBy(_window(df, moment, duration).alias("_w")).agg(*aggregates)
    values = [c for c in counted.columns if c != "_w"]
    return counted.select(
        F.col("_w.start").alias("window_start"),
        *[F.lit(v).alias(k) for k, v in (tags or {}).items()],
        *[f"`{c}`" for c in values],
    )


def window_counter(df: DataFrame, moment: str, duration: str, condition: Column, name: str) -> DataFrame:
    """(metric_ts = window end, count of rows meeting the condition), windows without one left out.

    Rows without a time that meet the condition are counted under a null metric_ts.
    """
    counted = df.where(condition).groupBy(_window(df, moment, duration).alias("_w")).agg(F.count(F.lit(1)).alias(name))
    return counted.select(F.col("_w.end").alias("metric_ts"), name)


def window_stats(df: DataFrame, keys: Sequence[str], moment: str, value: str, size: str, slide: str) -> DataFrame:
    """Count, mean and population spread per key and sliding window, variance floored at 1e-9.

    Central moments come from Spark's own mergeable aggregate, which does not lose digits
    the way a sum of squares does.
    """
    variance = F.greatest(F.var_pop(value), F.lit(1e-9))
    return (
        df.where(F.col(moment).isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys, F.window(moment, size, slide).alias("_w"))
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), variance.alias("variance"))
        .select(
            *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
            "n", "mean", "variance", F.sqrt("variance").alias("stddev"),
        )
    )


def invalid_ratio(df: DataFrame, moment: str, duration: str, valid: Column) -> DataFrame:
    """Valid and invalid rows per window with invalid/(valid+1) and invalid/total."""
    ok = F.coalesce(valid, F.lit(False))
    counted = tumbling(
        df, moment, duration, [F.count_if(ok).alias("valid_count"), F.count_if(~ok).alias("invalid_count")]
    )
    return counted.withColumns(
        {
            "breach_ratio": F.round(F.col("invalid_count") / (F.col("valid_count") + 1), 6),
            "invalid_share": F.round(
                F.col("invalid_count") / (F.col("valid_count") + F.col("invalid_count")), 6
            ),
        }
    )


def long_form(df: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per metric: ids, metric_type, metric_value."""
    return df.unpivot(list(ids), list(names), "metric_type", "metric_value")


def breaches(long: DataFrame, limits: DataFrame) -> DataFrame:
    """Metric rows above the limit of their type; `limits` is (metric_type, limit_value)."""
    return long.join(limits, "metric_type").where(F.col("metric_value") > F.col("limit_value"))


def window_alerts(
    df: DataFrame, moment: str, condition: Column, sum_minutes: int, sum_limit: float, avg_minutes: int, avg_limit: float
) -> DataFrame:
    """Windows whose count of rows meeting the condition is above a limit, in two ways.

    `sum`: the count over `sum_minutes`; `avg`: the mean count per minute over `avg_minutes`,
    minutes without such a row left out, as a counter that is not sent has no value. Rows
    are counted by minute once, and each minute then goes to its window of either kind.
    """
    ended = window_counter(df, moment, "1 minute", condition, "n")
    minute = F.col("metric_ts") - F.make_dt_interval(mins=F.lit(1))
    number = F.floor(F.unix_seconds(minute.cast("timestamp")) / 60)

    def window_of(kind: str, minutes: int) -> Column:
        start = minute - F.make_dt_interval(mins=F.pmod(number, F.lit(minutes)).cast("int"))
        return F.struct(F.lit(kind).alias("alert"), start.alias("window_start"))

    placed = ended.select(
        "n", F.explode(F.array(window_of("sum", sum_minutes), window_of("avg", avg_minutes))).alias("w")
    )
    totals = placed.groupBy("w.alert", "w.window_start").agg(F.sum("n").alias("_sum"), F.avg("n").alias("_avg"))
    is_sum = F.col("alert") == "sum"
    value = F.when(is_sum, F.col("_sum").cast("double")).otherwise(F.col("_avg"))
    limit = F.when(is_sum, F.lit(float(sum_limit))).otherwise(F.lit(float(avg_limit)))
    return totals.select("alert", "window_start", value.alias("metric_value")).where(F.col("metric_value") > limit)


SPINE_CHUNK = 10_000


def stalled_windows(df: DataFrame, moment: str, minutes: int, valid: Column) -> DataFrame:
    """Windows between the first and the last event without any valid row.

    Windows are numbered from the first one in steps of their own size, so every size lines up with
    the windows of the rows. The spine grows with the time span, not with the rows, and is cut in
    chunks of windows that are spread over tasks.
    """
    step = minutes * 60
    start = F.window(moment, f"{minutes} minutes").start.cast("timestamp")
    timed = df.where(F.col(moment).isNotNull())
    first = F.unix_seconds(start)
    span = timed.agg(F.min(first).alias("first_w"), F.max(first).alias("last_w")).where("first_w is not null")
    last_number = F.expr(f"(last_w - first_w) div {step}")
    chunks = span.select(
        "first_w", last_number.alias("last_number"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_number, F.lit(SPINE_CHUNK).cast("bigint"))).alias("at")
    ).repartition("at")
    numbers = F.sequence(F.col("at"), F.least(F.col("at") + SPINE_CHUNK - 1, F.col("last_number")))
    number = chunks.select("first_w", F.explode(numbers).alias("number"))
    spine = number.select(F.timestamp_seconds(F.col("first_w") + F.col("number") * step).cast("timestamp_ntz").alias("window_start"))
    good = timed.where(valid).select(start.cast("timestamp_ntz").alias("window_start")).distinct()
    return spine.join(good, "window_start", "left_anti")


def stalled_by_key(df: DataFrame, keys: Sequence[str], moment: str, minutes: int, valid: Column, idle_windows: int, until: Column) -> DataFrame:
    """(keys, window_start) of the windows of each key without a valid row, from its first row up to `until`.

    A key without any row for `idle_windows` windows is no longer watched until its next one. Rows are brought to one per
    key and window first, on the map side; between two of them at most `idle_windows` windows are made.
    """
    step = minutes * 60
    start = F.unix_seconds(F.col(moment).cast("timestamp"))
    held = (
        df.where(F.col(moment).isNotNull())
        .dropna(subset=list(keys))
        .groupBy(*keys, (start - F.pmod(start, F.lit(step))).alias("_w"))
        .agg(F.max(F.coalesce(valid, F.lit(False))).alias("_valid"))
    )
    following = F.lead("_w").over(Window.partitionBy(*keys).orderBy("_w"))
    end = F.coalesce(following, F.unix_seconds(until.cast("timestamp")))
    last = F.least(F.col("_end") - step, F.col("_w") + idle_windows * step)
    after = F.when(last > F.col("_w"), F.sequence(F.col("_w") + step, last, F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    own = F.when(F.col("_valid"), F.array().cast("array<bigint>")).otherwise(F.array("_w"))
    found = held.withColumn("_end", end).select(*keys, F.explode(F.concat(own, after)).alias("_s"))
    return found.select(*keys, F.timestamp_seconds("_s").cast("timestamp_ntz").alias("window_start"))


def error_rate(df: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    wrong = F.coalesce(bad, F.lit(False))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(wrong).alias("errors"))
        .withColumns(
            {
                "error_rate_pct": F.round(F.col("errors") * 100 / F.col("total"), 6),
                "availability": F.round((F.col("total") - F.col("errors")) / F.col("total"), 6),
            }
        )
    )


def word_counts(df: DataFrame, text: str, moment: str | None = None, duration: str = "5 seconds") -> DataFrame:
    """Occurrences of each lower-cased word between white space, per time window if one is named."""
    words = F.explode(F.split(F.lower(F.col(text)), "\\s")).alias("word")
    rows = df.select(words, *([moment] if moment else [])).where("word <> ''")
    if moment is None:
        return rows.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    counted = rows.groupBy("word", F.window(moment, duration).alias("_w")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select("word", F.col("_w.start").alias("window_start"), "count")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_flag(df: DataFrame, keys: Sequence[str], alias: str = "duplicate_check") -> DataFrame:
    """PASS or FAIL per row by whether its key repeats.

    A count over a window would bring every row of a hot key into one task; the
    count is taken as an aggregate instead and joined back to the rows, where AQE can
    split the hot key. Keys compare null-safe, as in a window partition.
    """
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("_repeats"))
    for k in keys:
        counted = counted.withColumnRenamed(k, f"_k_{k}")
    on = [df[k].eqNullSafe(counted[f"_k_{k}"]) for k in keys]
    return df.join(counted, on, "left").select(
        *[df[c] for c in df.columns], F.when(F.col("_repeats"), "FAIL").otherwise("PASS").alias(alias)
    )
