"""Session settings and the shared folders jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

ROWS_PER_CHUNK = "spark.rivulet.rowsPerChunk"
DEFAULT_ROWS_PER_CHUNK = 2_000_000

# Folders of local sessions that name none themselves.
_LOCAL_FOLDERS: dict[str, str] = {}

# Applications that have the library on their executors.
_SHIPPED: set[str] = set()

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ship(spark: SparkSession) -> None:
    """Put the library on the executors' path, once per application.

    Functions that run there refer to its modules, so it must not depend on what happens
    to be installed on the executors. Spark distributes the archive.
    """
    application = spark.sparkContext.applicationId
    root = os.path.dirname(os.path.abspath(__file__))
    if application in _SHIPPED or not os.path.isdir(root):
        return
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to a given session.

    Windows and "days" are aligned to the epoch, so the session zone is UTC. The
    RocksDB state store is what ``transformWithState`` needs and keeps large keyed
    state off the heap.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set(STATE_STORE, ROCKSDB)
    # Of several watermarked inputs the slowest counts.
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    ship(spark)
    return spark


def rows_per_chunk(spark: SparkSession) -> int:
    """How many rows of one key a single task may hold before the key is split."""
    return int(spark.conf.get(ROWS_PER_CHUNK, str(DEFAULT_ROWS_PER_CHUNK)))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) falls back to a folder of
    its own; on a cluster a machine-local folder would lose data, so it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="rivulet-")
    return _LOCAL_FOLDERS[application]


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/rivulet/{name}-{uuid.uuid4().hex}"


def stream_options(
    checkpoint: str,
    interval: str | None = None,
) -> dict:
    """Writer settings for a durable stream: its checkpoint and its trigger.

    Without an ``interval`` the stream processes what is available and stops.
    Offsets and state commit once per micro-batch, so ``interval`` is both the
    checkpoint interval and the minimum pause between checkpoints.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return {"checkpointLocation": checkpoint, "trigger": trigger}
