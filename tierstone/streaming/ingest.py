"""Incremental ingestion: each new file once, drift kept, progress in the checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.context import RunContext
from tierstone.sources.audit import audit_rows, listed_files, one_row_per_file
from tierstone.sources.csv_drops import files_by_header, literal, new_column_names, read_drops, tenant_glob

# What the binary file source offers; its content column is never selected.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
MAX_FILES_PER_BATCH = 10_000
#: No file is too old to be read: Spark's file streams otherwise skip those a week behind the newest.
ANY_AGE = "36500d"


class RawTable:
    """An append-only raw table: ``rows/batch_id=n/utility_id=x``, its audit and its column list."""

    def __init__(self, root: str, dataset: str, known: Sequence[str], evolve: bool = True):
        """``evolve`` lets new columns into the table; otherwise they go to rescued data."""
        self.root, self.dataset, self.known, self.evolve = root.rstrip("/"), dataset, list(known), evolve

    @property
    def rows_path(self) -> str:
        return f"{self.root}/rows"

    @property
    def audit_path(self) -> str:
        return f"{self.root}/audit"

    def _stored(self, spark: SparkSession, name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def columns(self, spark: SparkSession, before_batch: int | None = None) -> list[str]:
        """Known columns: the configured ones and those earlier batches let in."""
        added = self._stored(spark, "columns")
        if added is None:
            return self.known
        if before_batch is not None:
            added = added.filter(F.col("batch_id") < before_batch)
        return self.known + [r.column_name for r in added.orderBy("batch_id", "position").collect()]

    def schema(self, spark: SparkSession) -> T.StructType:
        """Schema of the stored rows, known without reading any file."""
        text, kinds = T.StringType(), {
            "_index_col_dropped": T.BooleanType(),
            "ingestion_timestamp": T.TimestampType(),
            "ingestion_date": T.DateType(),
        }
        names = [
            *self.columns(spark), "_rescued_data", "_index_col_dropped", "ingestion_timestamp", "ingestion_date",
            "pipeline_update_id", "source_file", "file_signature", "batch_id", "utility_id",
        ]
        kinds["batch_id"] = T.LongType()
        return T.StructType([T.StructField(n, kinds.get(n, text)) for n in names])

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; columns younger than a file are NULL there."""
        return spark.read.schema(self.schema(spark)).parquet(self.rows_path)

    def deliveries(self, spark: SparkSession) -> dict[str, list[int]]:
        """Run id of each ingestion that brought files -> its batches, oldest first; a few numbers per run."""
        audit = self._stored(spark, "audit")
        if audit is None:
            return {}
        found = audit.groupBy("pipeline_update_id").agg(
            F.collect_set("batch_id").alias("batches"), F.min("ingestion_timestamp").alias("at")
        )
        return {r.pipeline_update_id: sorted(r.batches) for r in found.orderBy("at", "pipeline_update_id").collect()}

    def tenants_of(self, spark: SparkSession, run_id: str) -> list[str]:
        """The tenants that one ingestion brought files of, by the audit."""
        audit = self._stored(spark, "audit")
        own = audit.filter((F.col("pipeline_update_id") == run_id) & F.col("utility_id").isNotNull())
        return [r[0] for r in own.select("utility_id").distinct().orderBy("utility_id").collect()]

    def read_delivery(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The rows of one ingestion; only its batches are read.  Files without rows leave it empty."""
        batches = self.deliveries(spark)[run_id]
        rows = self._stored(spark, "rows")
        if rows is None:
            return spark.createDataFrame([], self.schema(spark))
        return self.read(spark).filter(F.col("batch_id").isin(batches) & (F.col("pipeline_update_id") == run_id))

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.option("maxFileAge", ANY_AGE).schema(self.schema(spark)).parquet(self.rows_path)

    def read_audit(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.audit_path).drop("batch_id")

    def listed(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """Path, size and modification time of files, without their content."""
        return spark.read.format("binaryFile").load([literal(p) for p in paths]).select("path", "length", "modificationTime")

    def _new_files(self, spark: SparkSession, files: DataFrame, batch_id: int, run: RunContext) -> DataFrame:
        """Audit rows of those files that no earlier batch has stored."""
        rows = listed_files(files, self.dataset, run)
        audit = self._stored(spark, "audit")
        if audit is None:
            return rows
        return rows.join(audit.filter(F.col("batch_id") != batch_id).select("file_signature"), "file_signature", "left_anti")

    def write_batch(self, spark: SparkSession, paths: list[str], batch_id: int, run: RunContext) -> None:
        """Store one batch of files under its batch id, with one audit row for each, empty ones too.

        Files that the audit already names are left out, so what is new does not hang on the
        stream's progress alone. The audit is written last.  A replayed batch with an audit is
        complete and is left alone; one without is written over, so a crash never leaves rows twice.
        """
        if not paths or self._stored(spark, f"audit/batch_id={batch_id}") is not None:
            return
        new = self._new_files(spark, self.listed(spark, paths), batch_id, run).collect()
        if not new:
            return
        known = self.columns(spark, before_batch=batch_id)
        groups = files_by_header(spark, [r.file_path for r in new])
        added = new_column_names(groups, known) if self.evolve else []
        if added:
            entries = [(name, i) for i, name in enumerate(added)]
            table = spark.createDataFrame(entries, "column_name string, position int")
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/columns/batch_id={batch_id}")
        files = spark.createDataFrame(new)
        if groups:
            rows = read_drops(spark, groups, known + added, run)
            batch = f"{self.rows_path}/batch_id={batch_id}"
            rows.write.mode("overwrite").partitionBy("utility_id").parquet(batch)
            stored = spark.read.schema(self.schema(spark)).option("basePath", self.rows_path).parquet(batch)
            had = audit_rows(stored, self.dataset).groupBy("file_signature").agg(F.max("had_index_column_artifact").alias("had"))
            files = files.join(had, "file_signature", "left").withColumn(
                "had_index_column_artifact", F.coalesce("had", "had_index_column_artifact")
            ).select(*[c for c in files.columns])
        one_row_per_file(files).write.mode("overwrite").parquet(f"{self.audit_path}/batch_id={batch_id}")


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    table: RawTable,
    checkpoint: str,
    run: RunContext,
    max_files: int = MAX_FILES_PER_BATCH,
) -> None:
    """Take every file not seen before into ``table`` and stop.

    A file stream over path and length only finds the new files (their content is not read);
    each micro-batch of at most ``max_files`` is then read as CSV with its own headers.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE)
        .load(tenant_glob(landing, table.dataset))
        .select("path")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(batch.sparkSession, [r.path for r in batch.collect()], batch_id, run)

    query = (
        found.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_new_files(audit_stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append to ``out`` one row per file signature that is not there yet, however late its row comes.

    Each micro-batch is checked against all that is stored, so no row is dropped for its age and no
    duplicate passes for it. A batch is written under its number; a replay writes it over.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = one_row_per_file(batch)
        try:
            seen = spark.read.parquet(out).filter(F.col("batch_id") != batch_id).select("file_signature")
            first = first.join(seen, "file_signature", "left_anti")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        first.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        audit_stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
