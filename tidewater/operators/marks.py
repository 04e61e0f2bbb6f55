"""High-water marks: the control table of the incremental extract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import ntz
from tidewater.operators.upsert import upsert

MARK_COLS = ["table_name", "last_updated", "updated_at"]


def _fmt(ts) -> str:
    return ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)


def mark_rows(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    df = spark.createDataFrame(rows, "table_name string, last_updated string, updated_at string")
    return df.select("table_name", F.col("last_updated").cast("timestamp_ntz").alias("last_updated"),
                     F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


def initial_marks(spark: SparkSession, tables=("sales", "customers", "products"),
                  at: str = C.EPOCH_MARK) -> DataFrame:
    """The seeded control table: every table at 1900-01-01."""
    return mark_rows(spark, [(t, at, at) for t in tables])


def read_mark(marks: DataFrame, table: str) -> str:
    """Mark of ``table``; a table without a row starts at 1900-01-01.

    A single scalar reaches the driver; it becomes a literal predicate that
    Parquet / JDBC scans push down.
    """
    row = (marks.filter(F.col("table_name") == table)
           .agg(F.max("last_updated").alias("m")).first())
    return _fmt(row["m"]) if row and row["m"] is not None else C.EPOCH_MARK


def read_marks(marks: DataFrame) -> dict[str, str]:
    """All marks at once: the control table has one row per source table."""
    rows = marks.groupBy("table_name").agg(F.max("last_updated").alias("m")).collect()
    return {r["table_name"]: _fmt(r["m"]) for r in rows if r["m"] is not None}


def write_mark(marks: DataFrame, table: str, value, batch_ts: str) -> DataFrame:
    """Update the row of ``table``, inserting it when absent."""
    spark = marks.sparkSession
    return upsert(marks, mark_rows(spark, [(table, _fmt(value), batch_ts)]), ["table_name"], broadcast_batch=True)


def batch_max(df: DataFrame, column: str):
    """Greatest value of ``column`` (None for an empty frame)."""
    return df.agg(F.max(column).alias("m")).first()["m"]


def extract_delta(source: DataFrame, order_col: str, mark: str) -> DataFrame:
    """Rows strictly after the mark (``WHERE order_col > hwm``)."""
    return source.filter(F.col(order_col) > ntz(mark))


def late_rows(source: DataFrame, mirror: DataFrame, order_col: str, mark: str,
              keys=("id",)) -> DataFrame:
    """Rows at or before the mark that the mirror never received.

    The strict ``>`` of the extract skips a row that reaches the source after
    the mark passed its time; this audit lists them.
    """
    return (source.filter(F.col(order_col) <= ntz(mark))
            .join(mirror.select(*keys), list(keys), "left_anti"))
