"""Run log: start and end entries, appended to a folder as they happen.

Ids are claimed one by one: the file of an id can be created once, so that
processes that share a folder never give out the same one.

Every start and every end appends one small Parquet file, independent of the
run manifest, so a run that fails or dies leaves its RUNNING and FAILED entries
behind.  :meth:`RunLog.stored` reads the latest state of each entry.
"""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import micros_between
from tidewater.sources.commits import claim

LOG_SCHEMA = ("log_id bigint, process_name string, start_time timestamp_ntz, "
              "end_time timestamp_ntz, status string, rows_processed bigint, rows_inserted bigint, "
              "rows_updated bigint, rows_deleted bigint, error_message string, "
              "additional_info string, created_at timestamp_ntz")


COLUMNS = ["log_id", "process_name", "start_time", "end_time", "status", "rows_processed",
           "rows_inserted", "rows_updated", "rows_deleted", "error_message", "additional_info",
           "created_at"]


def _now() -> dt.datetime:
    return dt.datetime.now().replace(tzinfo=None)


class RunLog:
    """Append-only log; ``start`` returns the id, ``end`` completes the entry.

    Wall-clock times are used (a transaction-fixed timestamp would make every
    duration 0).  Entries are kept on the driver only as small metadata rows
    (one per pipeline step).  With a ``folder`` they are also appended there by
    :meth:`flush`; ids then continue after the largest stored one.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder
        self.rows: dict[int, dict] = {}
        self._changed: set[int] = set()
        self._lock = threading.RLock()  # steps run in threads; one append at a time
        stored = self.stored() if folder else None
        last = stored.agg(F.max("log_id")).first()[0] if stored is not None else None
        self._last = last or 0

    def _next_id(self) -> int:
        with self._lock:
            self._last += 1
            while self.folder and not claim(self.spark, f"{self.folder}/_ids/{self._last:012d}"):
                self._last += 1
            return self._last

    def start(self, process: str, info: dict | None = None) -> int:
        log_id = self._next_id()
        now = _now()
        row = dict(log_id=log_id, process_name=process, start_time=now, end_time=None,
                   status="RUNNING", rows_processed=0, rows_inserted=0, rows_updated=0,
                   rows_deleted=0, error_message=None,
                   additional_info=json.dumps(info, default=str) if info else None,
                   created_at=now)
        with self._lock:
            self.rows[log_id] = row
            self._changed.add(log_id)
        return log_id

    def end(self, log_id: int, status: str, processed: int = 0, inserted: int = 0,
            updated: int = 0, deleted: int = 0, error: str | None = None,
            info: dict | None = None) -> None:
        with self._lock:
            r = self.rows[log_id]
            self._changed.add(log_id)
        r.update(end_time=_now(), status=status, rows_processed=processed,
                 rows_inserted=inserted, rows_updated=updated, rows_deleted=deleted,
                 error_message=error)
        if info:  # COALESCE(new, old)
            r["additional_info"] = json.dumps(info, default=str)

    def _entries(self, ids) -> DataFrame:
        rows = [tuple(self.rows[i][k] for k in COLUMNS) for i in sorted(ids)]
        return self.spark.createDataFrame(rows, LOG_SCHEMA)

    def flush(self) -> None:
        """Append the entries that changed since the last flush."""
        with self._lock:
            if self.folder and self._changed:
                self._entries(self._changed).coalesce(1).write.mode("append").parquet(self.folder)
            self._changed.clear()

    def frame(self) -> DataFrame:
        """The entries of this process."""
        return with_duration(self._entries(self.rows))

    def stored(self) -> DataFrame | None:
        """All appended entries, of every process, in their latest state."""
        try:
            df = self.spark.read.schema(LOG_SCHEMA).parquet(self.folder)
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        state = F.struct(F.col("end_time").isNotNull(), "end_time", "status")
        latest = df.groupBy("log_id").agg(F.max_by(F.struct(*COLUMNS), state).alias("r"))
        return with_duration(latest.select("r.*"))


def with_duration(log: DataFrame) -> DataFrame:
    us = micros_between(F.col("start_time"), F.col("end_time"))
    return log.withColumn("duration_us", us).withColumn(
        "duration_seconds", us.cast("double") / F.lit(1e6))
