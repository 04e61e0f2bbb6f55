"""Slowly changing dimension, type 2, in one pass.

Current versions are full-outer-joined with the snapshot on the natural key.
Each key yields one row (new, unchanged or absent key) or two (changed key:
the closed old version and the new one) through ``inline(array(struct))``.
Closed history is passed through by union, never joined.  Change is
``NOT (old <=> new)`` on the tracked columns, so two nulls compare equal.
New versions get surrogate keys after the current maximum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import ntz
from tidewater.operators.keys import assign_keys, next_key


def scd2_merge(dim: DataFrame, snapshot: DataFrame, natural_key: str, tracked: Sequence[str],
               key_col: str, run_day: dt.date, batch_ts: str,
               extra_cols: dict | None = None, start: int | None = None,
               rows_bound: int | None = None) -> DataFrame:
    """Apply ``snapshot`` (natural key + tracked columns) to ``dim``.

    ``dim`` columns: key_col, natural_key, tracked..., extra..., valid_from,
    valid_to, is_current, loaded_at.  ``extra_cols`` maps untracked columns to
    their value for new versions (for instance region = null).  ``start`` is
    the current largest key when the caller already knows it; ``rows_bound``
    bounds the new versions (the snapshot size) to size the key partitions.
    """
    tracked = list(tracked)
    extra_cols = extra_cols or {}
    cols = dim.columns
    day = F.lit(run_day)
    cur = dim.filter(F.col("is_current")).alias("c")
    hist = dim.filter(~F.col("is_current"))
    snap = snapshot.select(natural_key, *tracked).withColumn("_in_s", F.lit(True)).alias("s")
    j = cur.withColumn("_in_c", F.lit(True)).alias("c").join(snap, natural_key, "full_outer")

    in_c, in_s = F.col("c._in_c").isNotNull(), F.col("s._in_s").isNotNull()
    same = F.lit(True)
    for t in tracked:
        same = same & F.col(f"c.{t}").eqNullSafe(F.col(f"s.{t}"))
    changed = in_c & in_s & ~same
    new = ~in_c & in_s

    def version(kind: str):
        fields = []
        for c in cols:
            if kind == "current":
                v = F.col(natural_key) if c == natural_key else F.col(f"c.{c}")
            elif kind == "closed":
                v = {"valid_to": day, "is_current": F.lit(False)}.get(c)
                if v is None:
                    v = F.col(natural_key) if c == natural_key else F.col(f"c.{c}")
            else:  # a new version from the snapshot
                if c == key_col:
                    v = F.lit(None).cast("long")
                elif c == natural_key:
                    v = F.col(natural_key)
                elif c in tracked:
                    v = F.col(f"s.{c}")
                elif c == "valid_from":
                    v = day
                elif c == "valid_to":
                    v = F.lit(C.OPEN_END).cast("date")
                elif c == "is_current":
                    v = F.lit(True)
                elif c == "loaded_at":
                    v = ntz(batch_ts)
                else:
                    v = extra_cols.get(c, F.lit(None))
            fields.append(v.cast(dim.schema[c].dataType).alias(c))
        return F.struct(*fields)

    rows = (F.when(changed, F.array(version("closed"), version("new")))
            .when(new, F.array(version("new")))
            .otherwise(F.array(version("current"))))
    merged = j.select(F.inline(rows))
    keyed = merged.filter(F.col(key_col).isNotNull())
    fresh = merged.filter(F.col(key_col).isNull()).drop(key_col)
    if start is None:  # largest existing key, unless the caller knows it
        start = next_key(dim, key_col)
    fresh = assign_keys(fresh, key_col, [natural_key], start=start,
                        rows_bound=rows_bound).select(*cols)
    return hist.unionByName(keyed).unionByName(fresh)


def empty_dimension(spark, key_col: str, natural_key: str, tracked: Sequence[str],
                    extra: Sequence[str] = ()) -> DataFrame:
    fields = [f"{key_col} bigint", f"{natural_key} bigint"]
    fields += [f"{c} string" for c in tracked] + [f"{c} string" for c in extra]
    fields += ["valid_from date", "valid_to date", "is_current boolean", "loaded_at timestamp_ntz"]
    return spark.createDataFrame([], ", ".join(fields))
