"""Surrogate keys: consecutive integers after the current maximum.

A global ``row_number()`` window would move every row into one task.  Here
the rows are range-partitioned and sorted by the order columns, pinned with a
reliable ``checkpoint()`` (range sampling must not differ between the count
and the numbering), numbered inside each partition with
``monotonically_increasing_id`` and shifted by the rows of all earlier
partitions.  The offsets table has one row per partition - a bound fixed by
the partition count, so broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import shared_root


def next_key(df: DataFrame, key_col: str) -> int:
    """Current maximum key (0 for an empty table): one scalar."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


ROWS_PER_PARTITION = 2_000_000


def partitions_for(spark, rows_bound: int | None, per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partition count sized by an upper bound of the rows (about
    ``per_partition`` rows each); the shuffle setting when no bound is known."""
    if rows_bound is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-int(rows_bound) // per_partition))


def assign_keys(df: DataFrame, key_col: str, order_cols: Sequence[str], start: int = 0,
                num_partitions: int | None = None, rows_bound: int | None = None,
                pin_input: bool = True) -> DataFrame:
    """Add ``key_col`` = start + row number of the row ordered by ``order_cols``.

    ``rows_bound`` (an upper bound of the rows, when the caller knows one)
    sizes the range partitions; ``num_partitions`` overrides it.
    ``pin_input`` first checkpoints the rows to number (usually the few new
    rows of a large join), so the range sampling and the shuffle read them
    instead of evaluating the upstream plan twice.
    """
    spark = df.sparkSession
    shared_root(spark)  # makes sure a checkpoint folder is set
    n = num_partitions or partitions_for(spark, rows_bound)
    if pin_input:
        df = df.checkpoint(eager=True)
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    return number_rows(ordered.checkpoint(eager=True), key_col, start)


def number_rows(pinned: DataFrame, key_col: str, start: int = 0) -> DataFrame:
    """Add ``key_col`` = start + row number to rows that lie in order already,
    within their partitions and from one to the next, and are pinned so."""
    tagged = (pinned.withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    keyed = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        key_col, (F.lit(start) + F.col("_off") + within + 1).cast("long"))
    return keyed.select(key_col, *pinned.columns)
