"""Follow a full-refresh table: every published run is handed on exactly once, as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierstone.sources.snapshots import MANIFEST_SCHEMA, SnapshotTable
from tierstone.streaming.ingest import ANY_AGE


def follow_runs(
    spark: SparkSession, table: SnapshotTable, checkpoint: str, handle: Callable[[DataFrame, str], None]
) -> None:
    """Call ``handle(rows, run_id)`` for each run published since the last call, oldest first.

    The stream reads the manifest, not the data: its few rows say which runs are complete.
    ``handle`` must write under the run id, so that a replay overwrites the same place.
    """
    def relay(batch: DataFrame, _: int) -> None:
        for row in batch.orderBy("version").collect():
            session = batch.sparkSession
            handle(session.read.parquet(table.run_path(row.run_id)), row.run_id)

    query = (
        spark.readStream.option("maxFileAge", ANY_AGE).schema(MANIFEST_SCHEMA).parquet(table.manifest_path)
        .writeStream.foreachBatch(relay)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_metrics(
    spark: SparkSession, table: SnapshotTable, checkpoint: str, out: str, metrics: Callable[[DataFrame], DataFrame]
) -> None:
    """Append the metrics of each new run under ``out/run_id=...``.

    An append-mode streaming aggregate would need a watermark and could split a run over batches;
    here a run arrives as a whole.
    """
    def store(rows: DataFrame, run_id: str) -> None:
        metrics(rows).write.mode("overwrite").parquet(f"{out}/run_id={run_id}")

    follow_runs(spark, table, checkpoint, store)
