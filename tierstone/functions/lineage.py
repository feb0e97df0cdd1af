"""Where a row came from: file path, tenant, signature, run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.context import RunContext


def tenant_from_path(path: Column, anchor: str = "landing") -> Column:
    """The path element after ``anchor``, or ``unknown`` without one."""
    parts = F.split(path, "/")
    at = F.array_position(parts, F.lit(anchor)).cast("int")
    return F.when(at > 0, F.try_element_at(parts, at + 1)).otherwise("unknown")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_signature(path: Column, size: Column, modified: Column) -> Column:
    """SHA-256 over path, size and modification time: the identity of a file, not its content."""
    return F.sha2(
        F.concat(
            path,
            F.coalesce(size.cast("string"), F.lit("0")),
            F.coalesce(modified.cast("string"), F.lit("")),
        ),
        256,
    )


def add_lineage(
    df: DataFrame,
    run: RunContext,
    path: Column | None = None,
    size: Column | None = None,
    modified: Column | None = None,
) -> DataFrame:
    """Add run id and clock; with ``path`` also source file and tenant, and with ``size`` and
    ``modified`` the file signature."""
    added = {
        "ingestion_timestamp": run.timestamp(),
        "ingestion_date": run.date(),
        "pipeline_update_id": F.lit(run.run_id),
    }
    if path is not None:
        added |= {"source_file": path, "utility_id": tenant_from_path(path)}
        if size is not None and modified is not None:
            added["file_signature"] = file_signature(path, size, modified)
    return df.withColumns(added)
