"""Idempotent upserts (``INSERT ... ON CONFLICT``) as DataFrame plans.

* :func:`latest_per_key` - one row per key, the greatest by ``order_cols``
  (rows arrive ordered by time, so for a repeated key the latest wins).
  ``max(struct(...))`` aggregates with a map-side partial step, so a hot key
  is collapsed before the shuffle and no per-key buffer is kept.
* :func:`upsert` - ``DO UPDATE`` of all columns (anti-join + union) or of a
  column subset (full outer join; the other columns keep the first value).
* :func:`insert_if_absent` - ``DO NOTHING``.
Replaying a batch gives the same table (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.joins import shuffled


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    keys, order_cols = list(keys), list(order_cols)
    payload = [c for c in df.columns if c not in keys]
    struct_cols = order_cols + [c for c in payload if c not in order_cols]
    latest = df.groupBy(*keys).agg(F.max(F.struct(*struct_cols)).alias("_latest"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c)
                           for c in df.columns])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None,
           order_cols: Sequence[str] | None = None,
           broadcast_batch: bool = False, matched: DataFrame | None = None,
           cluster: Sequence[str] = ()) -> DataFrame:
    """Merge ``batch`` into ``target`` on ``keys``.

    ``update_cols=None`` replaces whole rows; otherwise only those columns
    take the batch value on a key match and the rest keep the target's.
    Unmatched batch rows are inserted.  ``order_cols`` first reduces the batch
    to its latest row per key.  ``broadcast_batch`` (only when the caller
    has bounded the batch size) broadcasts the batch keys, so a large target
    is scanned and filtered without being shuffled.  ``matched`` gives the keys
    of the target rows that the batch replaces, where the caller has looked
    them up.  ``cluster`` (whole rows only) names columns, alike in a matched
    key and its target row, by which the result is to lie together: one shuffle
    by them does for the merge and for that layout.
    """
    keys = list(keys)
    if order_cols:
        batch = latest_per_key(batch, keys, order_cols)
    cols = target.columns
    batch = batch.select(*cols)
    if update_cols is None:
        batch_keys = batch.select(*keys) if matched is None else matched
        if cluster:
            return merge_clustered(target, batch, batch_keys, keys, cluster, {}, drop=True).select(*cols)
        batch_keys = batch_keys.select(*keys)
        batch_keys = F.broadcast(batch_keys) if broadcast_batch else shuffled(batch_keys)
        return target.join(batch_keys, keys, "left_anti").unionByName(batch)
    update = set(update_cols)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    b = batch.withColumn("_in_b", F.lit(True)).alias("b")
    j = t.join(b, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update:
            out.append(F.when(F.col("b._in_b"), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t._in_t"), F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*out)


def merge_clustered(target: DataFrame, fresh: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                    cluster: Sequence[str], update: dict[str, str], drop: bool = False) -> DataFrame:
    """``target`` with ``changes`` applied, and the ``fresh`` rows, in one shuffle.

    A change names a target row by ``keys`` and ``cluster``: the row goes
    (``drop``) or its columns take the change's (``update``: column -> column of
    the change).  All rows are moved by ``cluster`` once and stay there; keys
    are matched inside, so a null key matches nothing.
    """
    kind, cols = F.col("_kind"), target.columns
    rows = target.withColumn("_kind", F.lit(0))
    if fresh is not None:
        rows = rows.unionByName(fresh.select(*cols).withColumn("_kind", F.lit(1)))
    named = list(dict.fromkeys([*cluster, *keys]))
    changes = changes.dropna(subset=list(keys)).select(
        *named, *[F.col(c).alias(f"_new_{i}") for i, c in enumerate(update.values())], F.lit(2).alias("_kind"))
    w = Window.partitionBy(*named)
    rows = rows.unionByName(changes, allowMissingColumns=True).repartition(*cluster)
    rows = rows.withColumns({"_hit": F.max(kind).over(w) == 2,
                             **{f"_set_{i}": F.max(f"_new_{i}").over(w) for i in range(len(update))}})
    hit = (kind == 0) & F.col("_hit")
    rows = rows.filter((kind < 2) & ~hit if drop else kind < 2)
    values = {c: F.when(hit, F.col(f"_set_{i}")).otherwise(F.col(c)) for i, c in enumerate(update)}
    return rows.select(*[values[c].alias(c) if c in values else F.col(c) for c in cols])


def update_matched(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   update_cols: Sequence[str]) -> DataFrame:
    """Only the ``DO UPDATE`` half: matched target rows take ``update_cols``."""
    keys = list(keys)
    b = batch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update_cols]) \
        .withColumn("_in_b", F.lit(True))
    j = target.join(b, keys, "left")
    return j.select(*[F.when(F.col("_in_b"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                      if c in update_cols else F.col(c) for c in target.columns])


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target (the insert half)."""
    return batch.join(shuffled(target.select(*keys)), list(keys), "left_anti")


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``."""
    return target.unionByName(new_rows(target, batch.select(*target.columns), keys))
