"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Lower-cases A-Z on UTF-8 bytes and leaves every other byte alone.
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32

MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


_SHIPPED: set[str] = set()
#: Rows of an Arrow batch.  Spark's default of 10,000 whole texts would be held
#: several times over by an executor and its Python workers.
ARROW_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Prepare a session for the Python operators.

    Sends the package's code to the executors, once per application, so that
    their Python workers can import it wherever they run (Spark serves the
    archive from the driver; it holds code only), and bounds the rows of an
    Arrow batch where the session has a larger bound.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, ARROW_ROWS)
    app = spark.sparkContext.applicationId
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _SHIPPED or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidewater-code-"), "tidewater.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def trimmed(run):
    """A task function that hands its memory back to the system when it ends.

    Spark reuses Python workers, and what a task freed stays with its process:
    without this, idle workers of earlier stages add to an executor's memory.
    """
    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)
    return task


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The given table, only the named columns."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once under the shared folder and reread it.

    Lost executors then cost a reread, never a recomputation of the upstream
    jobs.  The folder is the one named by ``spark.checkpoint.dir``.
    """
    path = f"{shared_root(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits of a polynomial hash are usable."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX1
    h ^= h >> np.uint64(27)
    h *= MIX2
    h ^= h >> np.uint64(31)
    return h
