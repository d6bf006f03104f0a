"""Session construction and the shared scratch folder.

The session settings that carry weight for this library:

* ``spark.sql.session.timeZone=UTC`` — month keys and event times are UTC.
* ``spark.sql.sources.partitionOverwriteMode=dynamic`` — a rerun replaces only
  the partitions it touches (idempotent Bronze / Silver rewrites).
* ``spark.sql.sources.partitionColumnTypeInference.enabled=false`` — reading
  back ``symbol=007`` must stay the string ``007``.
* AQE on — runtime coalescing, skew-join splitting and size-checked
  broadcast conversion.

Everything the library writes (rewrites, streaming checkpoints, lineage cuts)
goes below the folder named by ``spark.checkpoint.dir``: on a cluster that is a
shared file system every executor sees. We only set our own value where the
session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark") -> SparkSession:
    """Return the active session (or build a local one) with our settings applied."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


# Recommended for large clusters (not applied by default: on one machine they
# would merge the small test inputs into a single task).  Shuffles start wide
# and AQE coalesces them to ~256 MB partitions by size, not by core count.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if cluster:
        for key, value in CLUSTER_CONF.items():
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


SCRATCH_KEY = "spark.tidemark.scratch.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``).

    ``spark.checkpoint.dir`` is a core setting that cannot change at runtime,
    so when the session names no folder a scratch folder is made — on a local
    master only (tests) — and kept under ``spark.tidemark.scratch.dir``.  On a
    cluster without a shared folder nothing machine-local is invented.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = (spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
               or spark.conf.get(SCRATCH_KEY, None))
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(SCRATCH_KEY, current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


#: The folders that this process has asked for, in order.
_made: list[str] = []


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh folder below the shared checkpoint folder, for rewrites and streams."""
    base = ensure_checkpoint_dir(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = base.rstrip("/") + "/tidemark/" + leaf if "://" in base else os.path.join(base, "tidemark", leaf)
    _made.append(path)
    return path


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the folders that were asked for inside the block.  For whole
    jobs: results that were not written elsewhere read these folders."""
    first = len(_made)
    try:
        yield
    finally:
        for path in _made[first:]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        del _made[first:]
