"""Incremental mirror load as a file stream.

Source files landed in a folder are read with ``readStream``; each
micro-batch is reduced to its latest row per key and upserted into the
mirror table (a new store version) inside ``foreachBatch``.  The stream's
checkpoint records which files were consumed, so it replaces the
high-water mark: a file that lands late is still picked up, which the
strict ``> mark`` filter would miss.  ``trigger(availableNow=True)`` makes
each run a bounded, restartable job.  Each applied batch commits the mirror's
new version together with the stream's id and the batch id to a manifest beside
the table; a new process restores them, and a batch that Spark replays because
the process died between the commit and the stream's checkpoint is skipped.  A
new checkpoint folder is a new stream: its batch ids start again at 0, and its
batches are applied (the upsert makes files that were read before harmless).
Of two streams that write one table at once the second to commit fails and
resumes from the state of the first.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence


from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.joins import max_broadcast_rows

from tidewater.operators.upsert import latest_per_key, upsert
from tidewater.sources.store import LayerStore

SALES_SCHEMA = ("id bigint, customer_id bigint, product_id bigint, qty int, "
                "transaction_date timestamp_ntz, created_at timestamp_ntz")
MIRROR_COLS = ["id", "customer_id", "product_id", "qty", "transaction_date"]


class StreamingMirror:
    """Keeps the mirror table of one source folder up to date."""

    def __init__(self, spark: SparkSession, store: LayerStore, table: str, landing: str,
                 checkpoint: str, schema: str = SALES_SCHEMA,
                 cols: Sequence[str] = tuple(MIRROR_COLS), keys: Sequence[str] = ("id",),
                 order_cols: Sequence[str] = ("transaction_date", "product_id", "qty",
                                              "customer_id")):
        self.spark, self.store, self.table = spark, store, table
        self.landing, self.checkpoint, self.schema = landing, checkpoint, schema
        self.cols, self.keys, self.order_cols = list(cols), list(keys), list(order_cols)
        self.batches: list[int] = []
        self.manifest = f"manifest-stream-{table}"
        committed = store.load_manifest(self.manifest)
        store.restore(committed)
        #: stream id -> last batch applied
        self.applied: dict[str, int] = {}
        for e in committed:
            stream = json.loads(e["marks"])["stream"]
            self.applied[stream] = max(e["run"], self.applied.get(stream, -1))

    def _empty(self) -> DataFrame:
        fields = {f.name: f.dataType.simpleString()
                  for f in self.spark.createDataFrame([], self.schema).schema.fields}
        ddl = ", ".join(f"{c} {fields[c]}" for c in self.cols)
        return self.spark.createDataFrame([], ddl + ", batch_id bigint")

    def stream_id(self) -> str:
        """The id that Spark gave the stream of this checkpoint folder."""
        return json.loads(self.spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]

    def _apply(self, batch: DataFrame, epoch_id: int) -> None:
        stream = self.stream_id()
        if epoch_id <= self.applied.get(stream, -1):  # replayed after a failure
            return
        latest = latest_per_key(batch.select(*self.cols), self.keys, self.order_cols)
        latest = latest.withColumn("batch_id", F.lit(epoch_id).cast("long"))
        # pin the micro-batch once and count it; a small batch filters the
        # mirror through broadcast keys instead of shuffling the mirror
        obs = Observation(f"stream_{self.table}_{epoch_id}_{uuid.uuid4().hex[:8]}")
        latest = latest.observe(obs, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
        rows = int(obs.get["rows"])
        if rows == 0:
            return
        target = self.store.read_or(self.table, self._empty())
        self.store.write(self.table, upsert(target, latest, self.keys,
                                            broadcast_batch=rows <= max_broadcast_rows(latest)))
        version = self.store.versions[self.table]
        self.store.commit(epoch_id, {self.table: version}, {}, {}, {"stream": stream},
                          dt.datetime.now().isoformat(sep=" "), manifest=self.manifest,
                          name=f"version-{version:08d}")
        self.applied[stream] = epoch_id
        self.batches.append(epoch_id)

    def run_available(self) -> None:
        """Consume every file landed so far, then stop."""
        stream = (self.spark.readStream.schema(self.schema).format("parquet")
                  .option("recursiveFileLookup", "true").load(self.landing))
        query = (stream.writeStream.foreachBatch(self._apply)
                 .option("checkpointLocation", self.checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    def result(self) -> DataFrame:
        return self.store.read(self.table) if self.store.has(self.table) else self._empty()
