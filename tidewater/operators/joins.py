"""Join helpers: size-checked broadcast or none, star join, as-of join, skip report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
_CONF_KEY = "tidewater.broadcast.maxRows"


def max_broadcast_rows(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get(_CONF_KEY, str(DEFAULT_MAX_BROADCAST_ROWS)))
    except Exception:  # pragma: no cover - conf access refused
        return DEFAULT_MAX_BROADCAST_ROWS


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that no bound is known for, or one above the limit.

    Without a hint Spark broadcasts what it takes for small by the size of the
    files, compressed and cut to the columns read, wherever the session leaves
    ``spark.sql.autoBroadcastJoinThreshold`` on: millions of rows may be collected
    on the driver.  A sort-merge join moves both sides instead.
    """
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, known_rows: int | None = None,
                       max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only behind a proven size bound.

    ``known_rows`` is an upper bound the caller already has (for instance the
    row count recorded when the table was written); otherwise the rows are
    counted.  Above the limit the join is a shuffle join, whatever the session
    broadcasts by estimates (AQE splits skewed keys).
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    rows = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if rows <= limit else shuffled(df)


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, at: str,
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               open_start: str | None = "1900-01-01",
               versions_rows: int | None = None) -> DataFrame:
    """Point-in-time join: the version of ``key`` valid at ``facts[at]``.

    Equi-join on the natural key plus ``valid_from <= at < valid_to``; with
    ``open_start`` the earliest version of each key counts as valid from that
    date, so facts older than the first load still find their version.
    Versions per key are few, so the equi-join bounds the pairs per key.
    ``versions_rows`` (a known bound) lets small version tables be broadcast,
    so the facts are not shuffled.
    """
    if open_start is not None:
        first = versions.groupBy(key).agg(F.min(valid_from).alias("_first_from"))
        versions = (versions.join(first, key)
                    .withColumn(valid_from, F.when(F.col(valid_from) == F.col("_first_from"),
                                                   F.lit(open_start).cast("date"))
                                .otherwise(F.col(valid_from)))
                    .drop("_first_from"))
    if versions_rows is not None:
        versions = broadcast_if_small(versions, versions_rows)
    v = versions.alias("v")
    f = facts.alias("f")
    cond = ((F.col(f"f.{key}") == F.col(f"v.{key}"))
            & (F.col(f"v.{valid_from}") <= F.col(f"f.{at}"))
            & (F.col(f"f.{at}") < F.col(f"v.{valid_to}")))
    return f.join(v, cond)


def skipped_rows(rows: DataFrame, customers: DataFrame, products: DataFrame,
                 customer_col: str = "customer_id", product_col: str = "product_id",
                 rows_c: int | None = None, rows_p: int | None = None) -> DataFrame:
    """Rows whose customer or product has no current version, with the reason.

    ``rows_c`` / ``rows_p`` bound the dimension sizes; within the broadcast
    limit the id lists are broadcast and ``rows`` is not shuffled.
    """
    cust_ids = customers.select(F.col("customer_id").alias("_c")).withColumn("_hc", F.lit(True))
    prod_ids = products.select(F.col("product_id").alias("_p")).withColumn("_hp", F.lit(True))
    if rows_c is not None:
        cust_ids = broadcast_if_small(cust_ids, rows_c)
    if rows_p is not None:
        prod_ids = broadcast_if_small(prod_ids, rows_p)
    j = (rows.join(cust_ids, F.col(customer_col) == F.col("_c"), "left")
         .join(prod_ids, F.col(product_col) == F.col("_p"), "left")
         .filter(F.col("_hc").isNull() | F.col("_hp").isNull()))
    reason = (F.when(F.col("_hc").isNull() & F.col("_hp").isNull(), "missing customer and product")
              .when(F.col("_hc").isNull(), "missing customer")
              .otherwise("missing product"))
    return j.withColumn("reason", reason).drop("_c", "_hc", "_p", "_hp")

