"""S4 as a streaming sink: every batch goes to several targets, and a log says which of
them hold it.

The log has one row per (batch, target), replaced when the target is written again.  A
batch that one target at least holds is safe: the stream goes on, and what another target
missed is copied there later, that target's failed batches alone.  A batch that no target
took stops the stream, whose next start replays it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.bronze import failure_text, write_partitioned
from tidemark.streaming.ingest import run_available_now

_LOG = "batch_id bigint, target string, ok boolean, error string"


def _write(rows: DataFrame, path: str, day_col: str) -> str | None:
    """None, or why the target wasn't written."""
    try:
        write_partitioned(rows, path, [day_col, "batch_id"])
    except Exception as error:  # noqa: BLE001 - the log holds it
        return failure_text(error)
    return None


def _log(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Rows of the log; a (batch, target) is a folder of its own, so rewriting one leaves
    all others."""
    write_partitioned(spark.createDataFrame(rows, _LOG), f"{root}/log", ["batch_id", "target"])


def save_log(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, target, ok, error), one row per batch and target."""
    try:
        return spark.read.schema(_LOG).parquet(f"{root}/log").select("batch_id", "target", "ok", "error")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def retry_failed(spark: SparkSession, targets: Mapping[str, str], root: str, day_col: str = "day") -> int:
    """Write what targets have missed, from a target that holds it; returns how many
    (batch, target) are still missing."""
    log = save_log(spark, root)
    missing: dict[tuple[str, str], list[int]] = {}
    held = {(r.batch_id, r.target) for r in log.where("ok").join(
        log.where("NOT ok").select("batch_id").distinct(), "batch_id").collect()}  # failed batches alone
    for r in log.where("NOT ok").collect():
        source = next((t for t in targets if (r.batch_id, t) in held), None)
        if r.target in targets and source is not None:
            missing.setdefault((r.target, source), []).append(r.batch_id)
    left = 0
    for (target, source), batches in missing.items():
        rows = spark.read.option("basePath", targets[source]).parquet(targets[source]) \
            .where(F.col("batch_id").isin([str(b) for b in batches]))
        error = _write(rows, targets[target], day_col)
        _log(spark, root, [(b, target, error is None, error) for b in batches])
        left += len(batches) if error else 0
    return left


def save_stream(stream: DataFrame, targets: Mapping[str, str], root: str, day_col: str = "day") -> DataFrame:
    """Land a stream in every target, all that is available; returns the log.  What an earlier
    run has left missing is retried first."""
    spark = stream.sparkSession
    retry_failed(spark, targets, root, day_col)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        try:
            errors = {name: _write(rows, path, day_col) for name, path in targets.items()}
        finally:
            rows.unpersist()
        _log(spark, root, [(batch_id, name, error is None, error) for name, error in errors.items()])
        if all(errors.values()):
            raise RuntimeError(f"no target took batch {batch_id}: {' | '.join(errors.values())}")

    run_available_now(stream, "save", root, foreach_batch=step)
    return save_log(spark, root)
