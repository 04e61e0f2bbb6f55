"""Data rules of the reference's DDL, re-aimed as quality jobs.

Each rule splits rows into valid and rejected instead of failing a load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import broadcast_if_small

# --- fixed values: the run-log statuses the reference's check constraint allows
STATUSES = ["RUNNING", "SUCCESS", "FAILED", "WARNING"]


def rule_positive(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) > 0)


def rule_not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def rule_max_length(c: str, n: int) -> Column:
    return F.col(c).isNull() | (F.length(c) <= n)


def rule_status(c: str = "status") -> Column:
    return F.col(c).isin(*STATUSES)


def load_rules(source: str) -> dict[str, Column]:
    """What a row of a source table must keep to be loaded (none where the
    table is not known)."""
    return {
        "sales": {"qty_positive": rule_positive("qty"),
                  "keys_not_null": rule_not_null("id", "customer_id", "product_id", "transaction_date")},
        "customers": {"id_not_null": rule_not_null("id"), "name_max_255": rule_max_length("name", 255),
                      "country_max_100": rule_max_length("country", 100)},
        "products": {"id_not_null": rule_not_null("id"), "name_max_255": rule_max_length("name", 255),
                     "group_max_100": rule_max_length("group_name", 100)},
    }.get(source, {})


def tagged(df: DataFrame, rules: dict[str, Column], column: str = "broken") -> DataFrame:
    """``df`` with the names of the rules that each row breaks."""
    names = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return df.withColumn(column, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def apply_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Return (valid, rejected); rejected carries the names of broken rules."""
    rows = tagged(df, rules, "_broken")
    valid = rows.filter(F.size("_broken") == 0).drop("_broken")
    rejected = rows.filter(F.size("_broken") > 0).withColumn(
        "failed_rules", F.array_join("_broken", ",")).drop("_broken")
    return valid, rejected


def rule_summary(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """rows_checked and rows_failed per rule, one pass over ``df``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, cond in enumerate(rules.values()):
        aggs.append(F.sum(F.when(~F.coalesce(cond, F.lit(False)), 1).otherwise(0)).alias(f"_f{i}"))
    one = df.agg(*aggs)
    stack = F.inline(F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("rule"),
                                        F.col("_n").alias("rows_checked"),
                                        F.col(f"_f{i}").cast("long").alias("rows_failed"))
                               for i, name in enumerate(rules)]))
    return one.select(stack)


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Keys that occur more than once (a partial count runs map-side)."""
    keys = list(keys)
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1)
            .select(F.lit(table).alias("table_name"), key_text.alias("key_value"), "copies"))


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str,
            reason: str) -> DataFrame:
    """Child rows whose reference has no parent row."""
    return (child.join(parent.select(F.col(parent_col).alias("_pk")).distinct(),
                       F.col(child_col) == F.col("_pk"), "left_anti")
            .withColumn("reason", F.lit(reason)))


def orphan_report(child: DataFrame, checks: list[tuple], keep: Sequence[str]) -> DataFrame:
    """One pass over ``child`` for several references.

    ``checks`` are (parent, child_col, parent_col, reason[, parent_rows]).
    Each parent's distinct keys are left-joined with a presence flag; a child
    row yields one output row per missing parent (``keep`` columns plus
    ``reason``).  With ``parent_rows`` (a known bound, such as a dimension's
    written row count) small parents are broadcast, so a large child is
    scanned once without any shuffle.
    """
    j = child
    reasons = []
    for i, check in enumerate(checks):
        parent, child_col, parent_col, reason = check[:4]
        bound = check[4] if len(check) > 4 else None
        keys = parent.select(F.col(parent_col).alias(f"_k{i}")).distinct() \
            .withColumn(f"_has{i}", F.lit(True))
        if bound is not None:
            keys = broadcast_if_small(keys, bound)
        j = j.join(keys, F.col(child_col) == F.col(f"_k{i}"), "left")
        reasons.append(F.when(F.col(f"_has{i}").isNull(), F.lit(reason)))
    missing = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return (j.select(*keep, missing.alias("_missing"))
            .filter(F.size("_missing") > 0)
            .select(*keep, F.explode("_missing").alias("reason")))


def cascade_keep(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str,
                 check_broadcast: bool = False) -> DataFrame:
    """Rows that survive a cascading delete of the parents not in ``parent``.

    ``check_broadcast`` counts the parent ids and broadcasts them when within
    the limit, so a large child is filtered without a shuffle.
    """
    keys = parent.select(F.col(parent_col).alias("_pk"))
    if check_broadcast:
        keys = broadcast_if_small(keys)
    return child.join(keys, F.col(child_col) == F.col("_pk"), "left_semi")
