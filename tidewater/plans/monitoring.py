"""Run-log and freshness analytics (views of the reference's log schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import ntz, round_half_up_ratio, seconds_from_micros

RECENT_COLS = ["log_id", "process_name", "start_time", "end_time", "duration_seconds",
               "status", "rows_processed", "error_message", "created_at"]


def recent_runs(log: DataFrame, n: int = C.RECENT_RUNS) -> DataFrame:
    """Latest n runs by start time, duration rounded to 2 (a top-k)."""
    return (log.withColumn("duration_seconds", seconds_from_micros(F.col("duration_us")))
            .select(*RECENT_COLS)
            .orderBy(F.desc("start_time"), F.desc("log_id")).limit(n))


def performance_summary(log: DataFrame) -> DataFrame:
    """Per process over finished runs: counts, rounded avg/max/min duration,
    rows and last start, newest first."""
    done = log.filter(F.col("end_time").isNotNull())
    g = done.groupBy("process_name").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0)).cast("long")
        .alias("successful_runs"),
        F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).cast("long")
        .alias("failed_runs"),
        F.sum("duration_us").alias("_sum_us"), F.count("duration_us").alias("_n_us"),
        F.max("duration_us").alias("_max_us"), F.min("duration_us").alias("_min_us"),
        F.sum("rows_processed").alias("total_rows_processed"),
        F.max("start_time").alias("last_run_time"))
    return g.select(
        "process_name", "total_runs", "successful_runs", "failed_runs",
        round_half_up_ratio(F.col("_sum_us"), F.col("_n_us") * F.lit(1_000_000))
        .alias("avg_duration_seconds"),
        seconds_from_micros(F.col("_max_us")).alias("max_duration_seconds"),
        seconds_from_micros(F.col("_min_us")).alias("min_duration_seconds"),
        "total_rows_processed", "last_run_time").orderBy(F.desc("last_run_time"))


def daily_trend(log: DataFrame) -> DataFrame:
    """Per process and day, successful runs: average and maximum duration in
    seconds (the average rounded to whole microseconds)."""
    ok = log.filter(F.col("status") == "SUCCESS")
    g = ok.groupBy("process_name", F.to_date("start_time").alias("day")).agg(
        F.sum("duration_us").alias("_s"), F.count("duration_us").alias("_n"),
        F.max("duration_us").alias("_m"))
    return g.select("process_name", "day",
                    round_half_up_ratio(F.col("_s"), F.col("_n") * F.lit(1_000_000), 6)
                    .alias("avg_duration"),
                    (F.col("_m").cast("double") / F.lit(1e6)).alias("max_duration")
                    ).orderBy(F.desc("day"), "process_name")


def failed_runs(log: DataFrame) -> DataFrame:
    return (log.filter(F.col("status") == "FAILED")
            .select("log_id", "process_name", "start_time", "end_time", "status",
                    "error_message", "rows_processed")
            .orderBy(F.desc("start_time"), F.desc("log_id")))


def runs_like(log: DataFrame, pattern: str = C.LIKE_PATTERN) -> DataFrame:
    """Runs whose process name matches a LIKE pattern ('_' is a wildcard)."""
    return (log.filter(F.col("process_name").like(pattern))
            .select("log_id", "process_name", "start_time", "status")
            .orderBy(F.desc("start_time"), F.desc("log_id")))


def freshness(marks: DataFrame, as_of_ts: str = C.AS_OF_TS) -> DataFrame:
    """Age of each high-water mark at ``as_of_ts``, oldest first."""
    return (marks.select("table_name", "last_updated",
                         F.timestamp_diff("SECOND", F.col("last_updated"), ntz(as_of_ts))
                         .alias("age_seconds"))
            .orderBy(F.desc("age_seconds"), "table_name"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of one count per layer."""
    out = None
    for layer, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
