"""One pipeline run: source -> mirror -> staging -> warehouse.

Every step reads the previous layer as a DataFrame, builds a set-based plan
and writes a new table version.  Only marks, maxima and row counts (scalars)
reach the driver.  The steps follow the reference's order: extract customers
and products, then sales; stage dimensions, then sales; calendar, both
dimensions, facts, and finally the sales mark.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import date_key, ntz
from tidewater.operators.calendar import CALENDAR_COLS, calendar, run_window
from tidewater.operators.cleaning import clean_customers, clean_products, date_parts, stage_sales
from tidewater.operators.joins import broadcast_if_small, max_broadcast_rows, shuffled
from tidewater.operators.keys import ROWS_PER_PARTITION, assign_keys, next_key, number_rows, partitions_for
from tidewater.operators.marks import extract_delta, initial_marks, read_marks, write_mark
from tidewater.operators.quality import apply_rules, load_rules, tagged
from tidewater.operators.runlog import RunLog
from tidewater.operators.scd2 import empty_dimension, scd2_merge
from tidewater.operators.upsert import latest_per_key, merge_clustered, new_rows, upsert
from tidewater.plans.metrics import product_months
from tidewater.session import shared_root
from tidewater.sources.commits import Conflict
from tidewater.sources.store import LayerStore

MRR_SCHEMAS = {
    "mrr_dim_customers": "id bigint, name string, country string, loaded_at timestamp_ntz",
    "mrr_dim_products": "id bigint, name string, group_name string, loaded_at timestamp_ntz",
    "mrr_fact_sales": ("id bigint, customer_id bigint, product_id bigint, qty int, "
                       "transaction_date timestamp_ntz, loaded_at timestamp_ntz"),
}
STG_SCHEMAS = {
    "stg_dim_customers": ("customer_id bigint, customer_name string, country string, "
                          "country_normalized string, valid_from timestamp_ntz, "
                          "loaded_at timestamp_ntz"),
    "stg_dim_products": ("product_id bigint, product_name string, product_group string, "
                         "product_group_normalized string, valid_from timestamp_ntz, "
                         "loaded_at timestamp_ntz"),
    "stg_fact_sales": ("sale_id bigint, customer_id bigint, product_id bigint, quantity int, "
                       "transaction_date timestamp_ntz, transaction_year int, "
                       "transaction_month int, transaction_day int, transaction_quarter int, "
                       "day_of_week int, loaded_at timestamp_ntz"),
}
FACT_SCHEMA = ("sale_key bigint, customer_key bigint, product_key bigint, date_key int, "
               "original_sale_id bigint, quantity int, transaction_date date, "
               "transaction_timestamp timestamp_ntz, loaded_at timestamp_ntz")
CALENDAR_SCHEMA = ("date_key int, date date, year int, quarter int, month int, "
                   "month_name string, week int, day_of_month int, day_of_week int, "
                   "day_name string, is_weekend boolean, is_holiday boolean")

# The three sales tables are kept in month folders (yyyyMM): a run rewrites the
# months it touches, and date ranges prune folders.
MONTH_KEY = "month_key"
PARTITION_COLS = {t: [MONTH_KEY] for t in ("mrr_fact_sales", "stg_fact_sales", "dwh_fact_sales")}
# When a staged sale last entered the mirror: kept in the files of staging only.
MIRRORED = "mirrored_at"
HIDDEN_COLS = {**PARTITION_COLS, "stg_fact_sales": [MONTH_KEY, MIRRORED]}
# Staged sales whose customer or product was unknown when last looked up.
SKIPPED = "stg_skipped_sales"

# extract: source table, mirror table, order column of the delta, mirror columns
EXTRACTS = [
    ("customers", "mrr_dim_customers", "created_at", ["id", "name", "country"]),
    ("products", "mrr_dim_products", "created_at", ["id", "name", "group_name"]),
    ("sales", "mrr_fact_sales", "transaction_date",
     ["id", "customer_id", "product_id", "qty", "transaction_date"]),
]
# Within one sales batch a repeated id keeps its latest row: ordered by time,
# then by the remaining payload, which makes the choice deterministic.
SALES_ORDER = ["transaction_date", "product_id", "qty", "customer_id"]


@dataclass
class Run:
    """One pipeline run.

    ``order_cols`` overrides the delta column per source table (the
    reference tests ``created_at`` for dimensions, so edits that only move
    ``updated_at`` are missed; pass ``{"customers": "updated_at"}`` to catch
    them).  ``calendar`` overrides the calendar window (default: 2 years
    back to 1 year ahead of ``day``).  ``rules`` overrides the rules (name ->
    condition) that rows of a source table must keep to be loaded.
    """
    number: int
    day: dt.date
    batch_ts: str
    sources: dict[str, DataFrame]
    order_cols: dict[str, str] = field(default_factory=dict)
    calendar: tuple[dt.date, dt.date] | None = None
    rules: dict[str, dict[str, Column]] = field(default_factory=dict)


@dataclass
class Warehouse:
    spark: SparkSession
    store: LayerStore
    log: RunLog
    runs: dict[int, dict] = field(default_factory=dict)   # per-run versions and marks
    rows: dict[str, int] = field(default_factory=dict)    # row count of the current versions
    max_keys: dict[str, int] = field(default_factory=dict)  # largest surrogate key written
    _frames: dict = field(default_factory=dict)  # read DataFrame per (table, version)

    def _read(self, name: str, run: int | None = None) -> DataFrame:
        """The stored version, read once per version: a DataFrame keeps its
        file index, so repeated queries do not list the folders again."""
        version = self.store.versions[name] if run is None else self.runs[run]["versions"][name]
        key = (name, version)
        if key not in self._frames:
            self._frames[key] = self.store.read(name, version)
        return self._frames[key]

    def table(self, name: str, run: int | None = None) -> DataFrame:
        return self._read(name, run).drop(*HIDDEN_COLS.get(name, []))

    def facts_between(self, start: dt.date | None, end: dt.date | None,
                      run: int | None = None) -> DataFrame:
        """Facts with ``start <= transaction_date <= end`` (either bound may be
        open); the month bounds prune partition directories at planning time."""
        df = self._read("dwh_fact_sales", run)
        if start is not None:
            df = df.filter((F.col(MONTH_KEY) >= start.year * 100 + start.month)
                           & (F.col("transaction_date") >= F.lit(start)))
        if end is not None:
            df = df.filter((F.col(MONTH_KEY) <= end.year * 100 + end.month)
                           & (F.col("transaction_date") <= F.lit(end)))
        return df.drop(MONTH_KEY)

    def write_months(self, run: Run, name: str, df: DataFrame | None, touched: set, key: str,
                     sort: list[str], clustered: bool = False, finish=None, placed: DataFrame | None = None,
                     **more) -> None:
        """Write the touched months of a table in month folders."""
        rows = month_layout(df, sort, clustered, finish, placed)
        parts = self.store.write_parts(name, rows, MONTH_KEY, touched, key, **more)
        self.rows[name] = parts.rows
        self.runs.setdefault(run.number, {"versions": {}, "marks": {}})
        self.runs[run.number]["versions"][name] = self.store.versions[name]

    def write(self, run: Run, name: str, df: DataFrame, key_col: str | None = None,
              partition_by: list[str] | None = None) -> dict:
        """Write a new version; the row count and the largest key are
        observed during the write (no extra job)."""
        metrics = [F.count(F.lit(1)).alias("rows")]
        if key_col:
            metrics.append(F.max(key_col).alias("max_key"))
        obs = Observation(f"{name}_{run.number}_{uuid.uuid4().hex[:8]}")
        self.store.write(name, df.observe(obs, *metrics), partition_by=partition_by)
        got = obs.get
        self.rows[name] = int(got["rows"])
        if key_col:
            self.max_keys[name] = int(got["max_key"] or 0)
        self.runs.setdefault(run.number, {"versions": {}, "marks": {}})
        self.runs[run.number]["versions"][name] = self.store.versions[name]
        return got

    def next_key(self, name: str, key_col: str) -> int:
        if name in self.max_keys:
            return self.max_keys[name]
        return next_key(self.table(name), key_col) if self.store.has(name) else 0

    def keep(self, run: Run, name: str) -> None:
        """Record that ``run`` left ``name`` unchanged."""
        self.runs.setdefault(run.number, {"versions": {}, "marks": {}})
        if self.store.has(name):
            self.runs[run.number]["versions"][name] = self.store.versions[name]

    def empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)


def new_warehouse(spark: SparkSession, root: str | None = None) -> Warehouse:
    shared_root(spark)  # set the checkpoint folder once, before any worker thread
    store = LayerStore(spark, root)
    return Warehouse(spark=spark, store=store, log=RunLog(spark, f"{store.root}/etl_log_entries"))


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Reopen a warehouse from its manifest (the committed runs only)."""
    wh = new_warehouse(spark, root)
    entries = wh.store.load_manifest()
    wh.store.restore(entries)
    for e in entries:
        run = wh.runs.setdefault(e["run"], {"versions": {}, "marks": {}})
        run["versions"][e["table_name"]] = e["version"]
        run["marks"] = json.loads(e["marks"] or "{}")
        if e["version"] == wh.store.versions[e["table_name"]]:
            if e["rows"] is not None:
                wh.rows[e["table_name"]] = e["rows"]
            if e["max_key"] is not None:
                wh.max_keys[e["table_name"]] = e["max_key"]
    return wh


def next_run_number(wh: Warehouse) -> int:
    return max(wh.runs, default=0) + 1


def commit_run(wh: Warehouse, run: Run) -> None:
    """Make the run visible to later processes (run-level atomicity)."""
    r = wh.runs[run.number]
    wh.store.commit(run.number, r["versions"],
                    {t: wh.rows.get(t) for t in r["versions"]},
                    {t: wh.max_keys.get(t) for t in r["versions"]},
                    r["marks"], run.batch_ts)


def _logged(wh: Warehouse, process: str, fn, log_id: int | None = None):
    wh.spark.sparkContext.setJobDescription(process)  # names the step's Spark jobs
    if log_id is None:
        log_id = wh.log.start(process)
        wh.log.flush()
    try:
        n = fn()
    except Exception as exc:  # log, then re-raise: the failed step publishes nothing
        wh.log.end(log_id, "FAILED", error=str(exc))
        wh.log.flush()
        raise
    n, info = n if isinstance(n, tuple) else (n, None)  # steps may add metadata
    wh.log.end(log_id, "SUCCESS", processed=int(n or 0), inserted=int(n or 0), info=info)
    wh.log.flush()
    return n


# --------------------------------------------------------------------------- extract
def prepare_marks(wh: Warehouse, run: Run) -> dict[str, str]:
    """Read all marks once per run (seeding the control table on first use)."""
    if not wh.store.has("high_water_mark"):
        wh.write(run, "high_water_mark", initial_marks(wh.spark))
    wh.keep(run, "high_water_mark")
    marks = read_marks(wh.table("high_water_mark"))
    used = {name: marks.get(name, C.EPOCH_MARK) for name, *_ in EXTRACTS}
    wh.runs[run.number]["marks"].update(used)
    return used


def extract_one(wh: Warehouse, run: Run, source_name: str) -> tuple[int, dict]:
    """Delta extract by mark and upsert into the mirror.

    The mark is a literal predicate pushed to the source scan.  The batch
    (latest row per id of the delta) is pinned with a checkpoint and counted
    while it is written: an empty delta is a success with 0 rows that leaves
    the mirror unchanged, and a batch within the broadcast limit has its keys
    broadcast, so the large mirror is filtered without a shuffle.  Rows that
    break a rule of the source do not enter the batch: they are counted in the
    same job and, where there are any, written to ``rejected_<source>``.
    """
    _, mirror, order_col, cols = next(e for e in EXTRACTS if e[0] == source_name)
    order_col = run.order_cols.get(source_name, order_col)
    mark = wh.runs[run.number]["marks"][source_name]
    delta = extract_delta(run.sources[source_name], order_col, mark)
    rules = run.rules.get(source_name, load_rules(source_name))
    order = SALES_ORDER if source_name == "sales" else [order_col]
    # the delta's largest order value (the batch maximum) and the batch size
    # are observed inside the one job that pins the batch
    tag = uuid.uuid4().hex[:8]
    obs_delta = Observation(f"delta_{source_name}_{tag}")
    broken = tagged(delta, rules).observe(
        obs_delta, F.max(order_col).alias("batch_max"),
        F.sum(F.when(F.size("broken") > 0, 1).otherwise(0)).alias("rejected"))
    keep = cols + [c for c in order if c not in cols]
    batch = (latest_per_key(broken.filter(F.size("broken") == 0).select(*keep), ["id"], order)
             .select(*cols).withColumn("loaded_at", ntz(run.batch_ts)))
    obs = Observation(f"batch_{source_name}_{tag}")
    batch = batch.observe(obs, F.count(F.lit(1)).alias("rows"), F.min("id").alias("low"),
                          F.max("id").alias("high")).checkpoint(eager=True)
    n = int(obs.get["rows"])
    top = obs_delta.get["batch_max"]
    wh.runs[run.number].setdefault("batch_max", {})[source_name] = (
        top.isoformat(sep=" ") if top is not None else None)
    rejected = int(obs_delta.get["rejected"] or 0)
    info = {"mark": mark, "batch_max": wh.runs[run.number]["batch_max"][source_name], "rejected": rejected}
    if rejected:
        quarantine(wh, run, source_name, apply_rules(delta, rules)[1])
    if n == 0:
        wh.keep(run, mirror)
        return 0, info
    small = n <= max_broadcast_rows(batch)
    if mirror in PARTITION_COLS:
        merge_months(wh, run, mirror, batch, obs.get["low"], obs.get["high"], small)
    else:
        target = wh.store.read_or(mirror, wh.empty(MRR_SCHEMAS[mirror]))
        wh.write(run, mirror, upsert(target, batch, ["id"], broadcast_batch=small))
    return n, info


def quarantine(wh: Warehouse, run: Run, source_name: str, rows: DataFrame) -> None:
    """Add the rejected rows of a batch, with the names of the rules they break,
    to the source's own table; the rows of earlier runs keep their files."""
    name = f"rejected_{source_name}"
    rows = rows.withColumns({"rejected_at": ntz(run.batch_ts), "run": F.lit(run.number)})
    parts = wh.store.write_parts(name, rows, "run", {run.number}, "id")
    wh.rows[name] = parts.rows
    wh.runs[run.number]["versions"][name] = wh.store.versions[name]


def merge_months(wh: Warehouse, run: Run, name: str, batch: DataFrame, low: int, high: int,
                 small: bool) -> None:
    """Upsert a pinned batch on ``id`` into a table in month folders.

    Touched are the batch's months and those in which its ids were stored
    before: a sale that moved leaves one month and enters another.  Only the id
    column of months whose id range meets the batch is searched for them.  The
    stored rows found there are pinned (id and month); up to the broadcast limit
    they filter the stored months in place, beyond it one shuffle by month does
    for the merge and for the layout.  The rows of a large batch are written where
    they are (:func:`tasks_in_place`).
    """
    batch = with_month(batch)
    rows = month_rows(batch)
    touched = set(rows)
    tasks = tasks_in_place(wh.spark, rows)
    more = {"sort": ["transaction_date", "id"], "state": {"batches": batches(wh, name, run)}}
    if not wh.store.has(name):
        moved, placed = (None, batch.coalesce(tasks)) if tasks else (batch, None)
        wh.write_months(run, name, moved, touched, "id", placed=placed, **more)
        return
    ids, stored = batch.select("id"), wh.store.parts(name)
    held = wh.store.read(name, only=stored.holding(low, high)).select("id", MONTH_KEY)
    matched = held.join(F.broadcast(ids) if small else shuffled(ids), "id", "left_semi").checkpoint(eager=True)
    found = month_rows(matched)
    touched |= set(found)
    target = wh.store.read(name, only=touched)
    clustered = sum(found.values()) > max_broadcast_rows(batch)
    moved, placed = (batch.limit(0), batch.coalesce(tasks)) if tasks else (batch, None)
    if clustered:
        salts = month_salts(stored, rows)
        merged = upsert(salted(target, "id", salts), salted(moved, "id", salts), ["id"],
                        matched=salted(matched, "id", salts), cluster=[MONTH_KEY, SALT]).drop(SALT)
    else:
        merged = upsert(target, moved, ["id"], broadcast_batch=True, matched=matched)
    wh.write_months(run, name, merged, touched, "id", clustered=clustered, placed=placed, **more)


def batches(wh: Warehouse, mirror: str, run: Run) -> dict | None:
    """The batches in the mirror, this one included, that the facts may not have
    seen: a name of its own for each, and its time.  None if a mirror of before
    has not kept them."""
    stored = wh.store.parts(mirror).state.get("batches") if wh.store.has(mirror) else {}
    if stored is None:
        return None
    facts = wh.store.parts("dwh_fact_sales").state if wh.store.has("dwh_fact_sales") else {}
    seen = facts.get("batches") or []
    return {**{b: at for b, at in stored.items() if b not in seen}, uuid.uuid4().hex[:12]: run.batch_ts}


def with_month(df: DataFrame, at: str = "transaction_date") -> DataFrame:
    return df.withColumn(MONTH_KEY, (F.year(at) * 100 + F.month(at)).cast("int"))


def month_rows(df: DataFrame) -> dict:
    """Rows by month; the calendar bounds how many months there are."""
    return {r[MONTH_KEY]: r["n"] for r in df.groupBy(MONTH_KEY).agg(F.count(F.lit(1)).alias("n")).collect()}


#: Rows that a task writes to each month on average, before new rows are written
#: by the tasks that have them instead of being moved to their month first.
FILE_ROWS = 10_000


def tasks_in_place(spark: SparkSession, rows: dict) -> int:
    """Into how many tasks new rows (a count by month) go that are written where
    they are; 0 if their files would be small, so that they are better moved."""
    n, months = sum(rows.values()), max(1, len(rows))
    tasks = max(partitions_for(spark, n), min(spark.sparkContext.defaultParallelism, n // (2 * FILE_ROWS * months)))
    return tasks if n >= tasks * months * FILE_ROWS else 0


SALT = "_salt"


def month_salts(stored, rows: dict) -> int:
    """Into how many pieces a month is cut, so that none of the largest month's
    exceeds ``ROWS_PER_PARTITION`` by much."""
    most = max((n + (stored.parts[m].rows if m in stored.parts else 0)
                for m, n in {**dict.fromkeys(stored.parts, 0), **rows}.items()), default=0)
    return max(1, -(-most // ROWS_PER_PARTITION))


def salted(df: DataFrame, key: str, salts: int) -> DataFrame:
    return df.withColumn(SALT, F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))


STAGE_DIMS = {
    "customers": ("mrr_dim_customers", "stg_dim_customers", clean_customers,
                  ["customer_name", "country", "country_normalized", "loaded_at"]),
    "products": ("mrr_dim_products", "stg_dim_products", clean_products,
                 ["product_name", "product_group", "product_group_normalized", "loaded_at"]),
}


def stage_dimension(wh: Warehouse, run: Run, kind: str) -> int:
    """Clean the whole mirror and upsert it; the SET list omits valid_from,
    so the first value survives."""
    mirror, stg, clean, attrs = STAGE_DIMS[kind]
    batch = clean(wh.table(mirror), run.batch_ts)
    target = wh.store.read_or(stg, wh.empty(STG_SCHEMAS[stg]))
    wh.write(run, stg, upsert(target, batch, [batch.columns[0]], update_cols=attrs))
    return wh.rows.get(mirror, 0)  # processed: the whole mirror


def stage_sales_table(wh: Warehouse, run: Run) -> int:
    """Stage the months whose mirror files changed since they were last staged.

    Every run stages the whole mirror, so all rows carry this run's
    ``loaded_at``: it is kept once for the version, and months whose mirror is
    unchanged keep their files.  The mirror's files hold one month each, so no
    row has to move: a task stages the files that it reads.  The mirror's own
    ``loaded_at`` is kept beside a sale, for the facts to find what is new.
    """
    name = "stg_fact_sales"
    mirror = wh.store.parts("mrr_fact_sales") if wh.store.has("mrr_fact_sales") else None
    source = {m: p.folder for m, p in mirror.parts.items()} if mirror else {}
    mine = wh.store.parts(name).parts if wh.store.has(name) else {}
    touched = {m for m in source.keys() | mine.keys()
               if m not in mine or mine[m].made_from != source.get(m)}
    rows = read_months(wh, "mrr_fact_sales", touched) if mirror else with_month(wh.empty(MRR_SCHEMAS["mrr_fact_sales"]))
    wh.write_months(run, name, rows.withColumnRenamed("loaded_at", MIRRORED), touched, "sale_id", ["transaction_date", "id"], clustered=True,
                    finish=lambda df: stage_sales(df, run.batch_ts, keep=[MIRRORED, MONTH_KEY]).withColumn(
                        "loaded_at", F.lit(None).cast("timestamp_ntz")),
                    made_from=source, constants={"loaded_at": run.batch_ts},
                    state={"batches": mirror.state.get("batches") if mirror else {}})
    return wh.rows.get("mrr_fact_sales", 0)


def read_months(wh: Warehouse, name: str, only: set) -> DataFrame:
    """Stored months, read in groups: Spark divides what one read covers among
    the cores, so the rows of a task stay near ``ROWS_PER_PARTITION`` however
    large the table is."""
    parts = wh.store.parts(name).parts
    most = ROWS_PER_PARTITION * wh.spark.sparkContext.defaultParallelism
    groups, size = [set()], 0
    for m in sorted(only & parts.keys(), key=lambda m: (m is not None, m)):
        if groups[-1] and size + parts[m].rows > most:
            groups.append(set())
            size = 0
        groups[-1].add(m)
        size += parts[m].rows
    out = wh.store.read(name, only=groups[0])
    for g in groups[1:]:
        out = out.unionByName(wh.store.read(name, only=g))
    return out


# --------------------------------------------------------------------------- warehouse
def load_calendar(wh: Warehouse, run: Run, start: dt.date | None = None,
                  end: dt.date | None = None) -> int:
    """Insert the run's calendar window; existing days are left alone."""
    if start is None or end is None:
        start, end = run.calendar or run_window(run.day)
    target = wh.store.read_or("dwh_dim_date", wh.empty(CALENDAR_SCHEMA))
    batch = calendar(wh.spark, start, end).select(*CALENDAR_COLS)
    added = new_rows(target, batch, ["date_key"])
    before = wh.rows.get("dwh_dim_date", 0)
    return wh.write(run, "dwh_dim_date", target.unionByName(added))["rows"] - before


def load_dimension(wh: Warehouse, run: Run, kind: str) -> int:
    if kind == "customers":
        stg, dim, key, nk, tracked, extra = ("stg_dim_customers", "dwh_dim_customers",
                                             "customer_key", "customer_id",
                                             ["customer_name", "country"], ["region"])
    else:
        stg, dim, key, nk, tracked, extra = ("stg_dim_products", "dwh_dim_products",
                                             "product_key", "product_id",
                                             ["product_name", "product_group"], [])
    snapshot = wh.table(stg).select(nk, *tracked)
    target = wh.store.read_or(dim, empty_dimension(wh.spark, key, nk, tracked, extra))
    target = target.select(key, nk, *tracked, *extra, "valid_from", "valid_to", "is_current",
                           "loaded_at")
    merged = scd2_merge(target, snapshot, nk, tracked, key, run.day, run.batch_ts,
                        extra_cols={c: F.lit(None).cast("string") for c in extra},
                        start=wh.next_key(dim, key), rows_bound=wh.rows.get(stg))
    wh.write(run, dim, merged, key_col=key)
    return wh.rows.get(stg, 0)  # processed: the staged snapshot


def current_keys(wh: Warehouse, kind: str) -> DataFrame:
    dim, nk, key = (("dwh_dim_customers", "customer_id", "customer_key") if kind == "customers"
                    else ("dwh_dim_products", "product_id", "product_key"))
    cur = wh.table(dim).filter(F.col("is_current")).select(nk, key)
    rows = wh.rows.get(dim)
    if rows is not None and rows > max_broadcast_rows(cur):
        rows = None  # of a long history fewer may be current: counted
    return broadcast_if_small(cur, known_rows=rows)


def load_facts(wh: Warehouse, run: Run) -> int:
    """Upsert facts on original_sale_id: a known sale changes only quantity and
    loaded_at (keys and dates stay as first loaded); new sales get keys.

    Looked up are the sales that came to the mirror since the last load, and those
    that were skipped before; every other sale has its fact already (a current
    customer or product stays one), which changes
    only in ``loaded_at``, kept once for the version.  A known sale that now
    lacks its customer or product keeps the ``loaded_at`` it had, in its row.
    The sales are joined with the current keys, then moved once by their id, which
    finds the stored facts and numbers new ones; months without a change keep their
    files.  What derives from a
    sale's time is left out of every shuffle and made again where rows are written.
    """
    name = "dwh_fact_sales"
    staged = wh.store.parts("stg_fact_sales")
    stored = wh.store.parts(name) if wh.store.has(name) else None
    source = {str(m): p.folder for m, p in staged.parts.items()}
    seen = stored.state["staged"] if stored else {}
    anew = {m for m, p in staged.parts.items() if seen.get(str(m)) != p.folder}
    gone = {m for m in seen if m not in source}
    sales = wh.store.read("stg_fact_sales", only=anew)
    came, had = staged.state.get("batches"), stored.state.get("batches") if stored else None
    if came is not None and had is not None:
        new = [F.lit(at).cast("timestamp_ntz") for b, at in came.items() if b not in had]
        at = F.col(MIRRORED)
        sales = sales.filter(at.isNull() | (at.isin(*new) if new else F.lit(False)) | F.col("sale_id").isNull())
    sales = sales.select(*SALE_COLS)
    if wh.store.has(SKIPPED):
        again = wh.table(SKIPPED)
        if anew or gone:  # a sale without an id is known by its month alone
            old = [m for m in anew if m is not None]
            again = again.filter(F.col("sale_id").isNotNull()
                                 | ~F.coalesce(F.col(MONTH_KEY).isin(old), F.lit(None in anew))
                                 & ~F.coalesce(F.col(MONTH_KEY).cast("string"), F.lit("None")).isin(list(gone)))
        sales = sales.withColumn(AGAIN, F.lit(False)).unionByName(
            again.select(*SALE_COLS, F.lit(True).alias(AGAIN)))

    pinned, counts = looked_up(wh, sales, stored)
    skipped = pinned.filter("NOT found")
    wh.write(run, SKIPPED, with_month(skipped.select(*SALE_COLS, *date_parts(F.col("transaction_date")))))
    fresh = pinned.filter("found AND NOT known").select(
        F.col("sale_id").alias("original_sale_id"), "customer_key", "product_key", "quantity",
        F.col("transaction_date").alias("transaction_timestamp"))
    rows = month_rows(with_month(fresh, "transaction_timestamp")) if counts["fresh"] else {}
    touched = set(rows)
    start = wh.next_key(name, "sale_key")
    tasks = tasks_in_place(wh.spark, rows)
    merged = placed = None
    if counts["fresh"] or stored is None:
        if stored is None:
            merged = assign_keys(fresh, "sale_key", ["original_sale_id"], start=start, num_partitions=tasks or None,
                                 rows_bound=counts["fresh"], pin_input=False)
        else:  # in the order of their ids already
            merged = number_rows(fresh, "sale_key", start)
        merged = with_month(merged.withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")),
                            "transaction_timestamp").select(*MOVED_COLS)
    if tasks:
        merged, placed = None, merged.coalesce(tasks)
    if counts["changed"]:
        change = pinned.filter("changed").select(
            F.col("sale_id").alias("original_sale_id"), F.lit(True).alias("hit"),
            F.when(F.col("found"), F.col("quantity")).otherwise(F.col("old_quantity")).alias("new_quantity"),
            F.when(~F.col("found"), F.lit(stored.constants["loaded_at"]).cast("timestamp_ntz")).alias("new_at"),
            F.col("fact_month").alias(MONTH_KEY))
        touched |= set(month_rows(change))
    clustered = False
    if stored is not None and touched:
        kept = wh.store.read(name, only=touched, raw=True).select(*MOVED_COLS)
        clustered = counts["changed"] > max_broadcast_rows(kept)
        if clustered:  # one shuffle by month does for the update and for the layout
            salts = month_salts(stored, rows)
            parts = [salted(df, "original_sale_id", salts) if df is not None else None for df in (kept, merged, change)]
            merged = merge_clustered(*parts, ["original_sale_id"], [MONTH_KEY, SALT],
                                     {"quantity": "new_quantity", "loaded_at": "new_at"}).drop(SALT)
        else:
            if counts["changed"]:
                change = F.broadcast(change.drop(MONTH_KEY))
                kept = (kept.join(change, "original_sale_id", "left")
                        .withColumn("quantity", F.when(F.col("hit"), F.col("new_quantity")).otherwise(F.col("quantity")))
                        .withColumn("loaded_at", F.when(F.col("hit"), F.col("new_at")).otherwise(F.col("loaded_at"))))
            kept = kept.select(*MOVED_COLS)
            merged = kept if merged is None else kept.unionByName(merged)
    if merged is None and placed is None:  # nothing changed but the time of loading
        merged = with_month(wh.empty(FACT_SCHEMA)).select(*MOVED_COLS)
    wh.write_months(run, name, merged, touched, "original_sale_id", ["transaction_timestamp", "original_sale_id"],
                    clustered=clustered, finish=with_days, placed=placed, latest="transaction_timestamp",
                    constants={"loaded_at": run.batch_ts},
                    state={"staged": source, "batches": None if came is None else list(came)})
    wh.max_keys[name] = start + counts["fresh"]
    return wh.rows.get("stg_fact_sales") or 0  # processed: every staged sale, skipped ones included


ROLLUP = "dwh_monthly_sales"
#: Sales per product and month up to which they are moved as they are.
FEW_SALES = 4


def refresh_rollup(wh: Warehouse, run: Run) -> None:
    """Sum again the months whose fact files changed since they were summed;
    all other months of the stored rollup keep theirs."""
    source = {m: p.folder for m, p in wh.store.parts("dwh_fact_sales").parts.items()}
    mine = wh.store.parts(ROLLUP).parts if wh.store.has(ROLLUP) else {}
    touched = {m for m in source.keys() | mine.keys() if m not in mine or mine[m].made_from != source.get(m)}
    facts = wh.store.read("dwh_fact_sales", only=touched, raw=True).select(MONTH_KEY, "product_key", "quantity")
    # few sales per product and month: summing them before a shuffle saves little,
    # so they are moved by month at once; else the sums are moved, twice
    stored = wh.store.parts("dwh_fact_sales")
    sales = sum(p.rows for m, p in stored.parts.items() if m in touched)
    clustered = sales < FEW_SALES * len(touched) * wh.rows.get("dwh_dim_products", 0)
    if clustered:
        facts = salted(facts, "product_key", month_salts(stored, {})).repartition(MONTH_KEY, SALT)
    rows = product_months(facts, [SALT] if clustered else [])
    wh.write_months(run, ROLLUP, rows.select("product_key", "total_quantity", "transaction_count", MONTH_KEY),
                    touched, "product_key", ["product_key"], clustered=clustered, made_from=source)


def load_sales(wh: Warehouse, run: Run) -> int:
    """The facts, then the rollup over them."""
    n = load_facts(wh, run)
    refresh_rollup(wh, run)
    return n


FACT_COLS = [f.split(" ")[0] for f in FACT_SCHEMA.split(", ")]
#: What facts are moved with; ``with_days`` gives the other columns back.
MOVED_COLS = [c for c in FACT_COLS if c not in ("date_key", "transaction_date")] + [MONTH_KEY]
SALE_COLS = ["sale_id", "customer_id", "product_id", "quantity", "transaction_date"]
#: Marks a sale that was skipped before and is looked up again.
AGAIN = "_again"


def with_days(facts: DataFrame) -> DataFrame:
    at = F.col("transaction_timestamp")
    return facts.withColumns({"date_key": date_key(at), "transaction_date": F.to_date(at)}).select(*FACT_COLS, MONTH_KEY)


def looked_up(wh: Warehouse, sales: DataFrame, stored) -> tuple[DataFrame, dict]:
    """The sales with their current keys (``found`` if both exist) and what the
    fact has of them (``known``, ``changed``), pinned, counted, and with stored
    facts in the order of their ids.  Where a sale is there twice, the row that is
    not marked as ``AGAIN`` counts."""
    keyed = (sales.join(current_keys(wh, "customers"), "customer_id", "left")
             .join(current_keys(wh, "products"), "product_id", "left")
             .withColumn("found", F.col("customer_key").isNotNull() & F.col("product_key").isNotNull())
             # only a skipped sale is asked for these again
             .withColumns({c: F.when(~F.col("found"), F.col(c)) for c in ("customer_id", "product_id")}))
    obs = Observation(f"lookup_{uuid.uuid4().hex[:8]}")
    is_fresh = F.sum((F.col("found") & ~F.col("known")).cast("long")).alias("fresh")
    if stored is None:
        keyed = keyed.withColumns({"known": F.lit(False), "changed": F.lit(False)}).drop(AGAIN)
        pinned = keyed.observe(obs, is_fresh).checkpoint(eager=True)
        return pinned, {"fresh": int(obs.get["fresh"] or 0), "changed": 0}
    span = Observation(f"keyed_{uuid.uuid4().hex[:8]}")
    keyed = keyed.observe(span, F.count(F.lit(1)).alias("n"), F.min("sale_id").alias("low"),
                          F.max("sale_id").alias("high")).checkpoint(eager=True)
    n, low, high = (span.get[k] for k in ("n", "low", "high"))
    if AGAIN not in keyed.columns:
        keyed = keyed.withColumn(AGAIN, F.lit(False))
    months = stored.holding(low, high)
    facts = wh.store.read("dwh_fact_sales", only=months, raw=True).select(
        F.col("original_sale_id").alias("sale_id"), F.col("quantity").alias("old_quantity"),
        F.col("loaded_at").alias("old_at"), F.col(MONTH_KEY).alias("fact_month"))
    if n <= max_broadcast_rows(keyed):
        facts = facts.join(F.broadcast(keyed.select("sale_id")), "sale_id", "left_semi")
    # one shuffle by ranges of the id: a fact meets its sale, and new sales get
    # into the order in which they are numbered
    size = n + sum(stored.parts[m].rows for m in months)
    same = Window.partitionBy("sale_id")
    has_id = F.col("sale_id").isNotNull()
    rows = keyed.withColumn("_sale", F.lit(True)).unionByName(
        facts.withColumn("_sale", F.lit(False)), allowMissingColumns=True)
    rows = rows.repartitionByRange(partitions_for(wh.spark, size), "sale_id").withColumns({
        "_known": has_id & F.max(~F.col("_sale")).over(same),
        "_anew": has_id & F.coalesce(F.max(F.col("_sale") & ~F.col(AGAIN)).over(same), F.lit(False)),
        **{f"_{c}": F.when(has_id, F.max(c).over(same)) for c in ("old_quantity", "old_at", "fact_month")}})
    rows = rows.filter(F.col("_sale") & ~(F.col(AGAIN) & F.col("_anew"))).select(
        *SALE_COLS, "customer_key", "product_key", "found", F.col("_known").alias("known"),
        F.col("_old_quantity").alias("old_quantity"), F.col("_old_at").alias("old_at"),
        F.col("_fact_month").alias("fact_month"))
    rows = rows.withColumn("changed", F.col("known") & F.when(
        F.col("found"), F.col("old_at").isNotNull() | (~F.col("quantity").eqNullSafe(F.col("old_quantity"))))
        .otherwise(F.col("old_at").isNull())).drop("old_at")
    pinned = rows.observe(obs, is_fresh, F.sum(F.col("changed").cast("long")).alias("changed")).checkpoint(eager=True)
    return pinned, {k: int(v or 0) for k, v in obs.get.items()}


def month_layout(df: DataFrame | None, sort: list[str], clustered: bool = False, finish=None,
                 placed: DataFrame | None = None) -> DataFrame:
    """Shape a table for month folders.

    ``rebalance`` on the month lets AQE size the write partitions from the
    measured shuffle (advisory partition size) and split a hot month into
    several tasks, without the sampling pass a range repartition costs; rows
    are sorted inside each task so Parquet row groups carry tight statistics
    for row-group skipping.  Rows that lie together by month already
    (``clustered``) are sorted where they are, as are those of ``placed``, rows in
    few enough tasks that each may write to every month; ``finish`` adds columns
    after that.
    """
    if df is not None and not clustered:
        df = df.hint("rebalance", MONTH_KEY)
    if placed is not None:
        df = placed if df is None else df.unionByName(placed)
    df = df.sortWithinPartitions(MONTH_KEY, *sort)
    return finish(df) if finish else df


def fact_layout(fact: DataFrame) -> DataFrame:
    """The fact, shaped for its month folders."""
    return month_layout(with_month(fact), ["transaction_date", "original_sale_id"])


def advance_sales_mark(wh: Warehouse, run: Run) -> None:
    """Mark = MAX(transaction_timestamp) of the fact, which the list of its
    months has; unchanged when it is empty."""
    top = wh.store.parts("dwh_fact_sales").latest
    if top is not None:
        wh.write(run, "high_water_mark",
                 write_mark(wh.table("high_water_mark"), "sales", top, run.batch_ts))
    wh.keep(run, "high_water_mark")


def run_until_committed(spark: SparkSession, root: str, make_run, attempts: int = 5) -> Warehouse:
    """Run ``make_run(number)`` on the warehouse under ``root``.

    When another process commits the same number first, the warehouse is read
    again and the run repeated on top of what the other one left.
    """
    for attempt in range(attempts):
        wh = open_warehouse(spark, root)
        try:
            return run_pipeline(wh, make_run(next_run_number(wh)))
        except Conflict:
            if attempt + 1 == attempts:
                raise
    raise ValueError("attempts must be positive")


def _parallel(wh: Warehouse, steps: list[tuple[str, object]]) -> None:
    """Run independent steps as concurrent Spark jobs (they read and write
    different tables); the first failure is raised after all finished."""
    ids = [wh.log.start(process) for process, _ in steps]
    wh.log.flush()
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(_logged, wh, process, fn, log_id)
                   for (process, fn), log_id in zip(steps, ids, strict=True)]
        for f in futures:
            f.result()


def run_pipeline(wh: Warehouse, run: Run) -> Warehouse:
    # source -> mirror: the three extracts touch different tables
    prepare_marks(wh, run)
    _parallel(wh, [(f"operational_to_mrr_{k}", lambda k=k: extract_one(wh, run, k))
                   for k in ("customers", "products", "sales")])
    # mirror -> staging: each staging table reads only its own mirror table
    _parallel(wh, [(f"mrr_to_stg_{k}", lambda k=k: stage_dimension(wh, run, k))
                   for k in ("customers", "products")]
              + [("mrr_to_stg_sales", lambda: stage_sales_table(wh, run))])
    # staging -> warehouse: calendar and both dimensions, then facts, then mark
    _parallel(wh, [("stg_to_dwh_date_dimension", lambda: load_calendar(wh, run))]
              + [(f"stg_to_dwh_{k}", lambda k=k: load_dimension(wh, run, k))
                 for k in ("customers", "products")])
    _logged(wh, "stg_to_dwh_sales", lambda: load_sales(wh, run))
    _logged(wh, "update_high_water_mark", lambda: (advance_sales_mark(wh, run), 1)[1])
    # the run log as a warehouse table: one row per step of every run so far,
    # failed ones and procedures included
    wh.write(run, "etl_logs", wh.log.stored(), key_col="log_id")
    # carry forward tables this run did not rewrite, then publish the run
    for name in list(wh.store.versions):
        if name not in wh.runs[run.number]["versions"]:
            wh.keep(run, name)
    commit_run(wh, run)
    return wh
