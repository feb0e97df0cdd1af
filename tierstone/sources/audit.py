"""One row per delivered file."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.context import RunContext
from tierstone.functions.lineage import file_name, file_signature, tenant_from_path
from tierstone.sources.csv_drops import plain_path

# Columns of the audit table.
AUDIT_COLUMNS = (
    "file_path", "file_name", "file_signature", "utility_id", "dataset_type", "ingestion_timestamp",
    "pipeline_update_id", "status", "had_index_column_artifact",
)


def audit_rows(raw: DataFrame, dataset: str) -> DataFrame:
    """Audit columns of raw rows; works on a batch and on a stream."""
    path = F.col("source_file")
    return raw.select(
        path.alias("file_path"),
        file_name(path).alias("file_name"),
        "file_signature",
        "utility_id",
        F.lit(dataset).alias("dataset_type"),
        "ingestion_timestamp",
        "pipeline_update_id",
        F.lit("SUCCEEDED").alias("status"),
        F.col("_index_col_dropped").cast("int").alias("had_index_column_artifact"),
    )


def listed_files(files: DataFrame, dataset: str, run: RunContext) -> DataFrame:
    """Audit columns of listed files (``path``, ``length``, ``modificationTime``), whether they have rows or not."""
    path = plain_path(F.replace("path", F.lit("%"), F.lit("%25")))
    return files.select(
        path.alias("file_path"),
        file_name(path).alias("file_name"),
        file_signature(path, F.col("length"), F.col("modificationTime")).alias("file_signature"),
        tenant_from_path(path).alias("utility_id"),
        F.lit(dataset).alias("dataset_type"),
        run.timestamp().alias("ingestion_timestamp"),
        F.lit(run.run_id).alias("pipeline_update_id"),
        F.lit("SUCCEEDED").alias("status"),
        F.lit(0).alias("had_index_column_artifact"),
    )


def one_row_per_file(rows: DataFrame) -> DataFrame:
    """First delivery of each signature; a file counts as having had the artifact if any row did.

    The aggregate combines a file's rows before the shuffle, so a huge file costs one row there.
    Every other column is a function of the file and the run, so grouping by them keeps the
    aggregate a hash aggregate.
    """
    first = rows.groupBy(*[c for c in AUDIT_COLUMNS if c != "had_index_column_artifact"]).agg(
        F.max("had_index_column_artifact").alias("had_index_column_artifact")
    )
    rest = [c for c in AUDIT_COLUMNS if c != "file_signature"]
    earliest = F.min(F.struct("ingestion_timestamp", "pipeline_update_id", *[
        c for c in rest if c not in ("ingestion_timestamp", "pipeline_update_id")
    ])).alias("f")
    return first.groupBy("file_signature").agg(earliest).select(*[
        F.col(c) if c == "file_signature" else F.col(f"f.{c}") for c in AUDIT_COLUMNS
    ])


def file_audit(raw_by_dataset: Mapping[str, DataFrame]) -> DataFrame:
    """Audit over the raw tables of all datasets."""
    rows = [audit_rows(df, name) for name, df in raw_by_dataset.items()]
    return one_row_per_file(reduce(lambda a, b: a.unionByName(b), rows))
