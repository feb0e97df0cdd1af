"""Shapes in which tenants deliver their data, each turned into the intermediate rows.

A layout is a function from raw rows to intermediate rows.  It never names a tenant: keys are
prefixed with the row's own ``utility_id``, so all tenants with one shape share one layout and
one branch of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.functions.cleaning import (
    drop_raw_tracking_columns,
    normalize_null_sentinels,
    optional_column,
    tenant_key,
)
from tierstone.functions.parsing import to_double
from tierstone.operators.reshape import rollup_segments, unpivot_positive
from tierstone.vocab import LINEAGE_COLUMNS, TECHNOLOGIES

Layout = Callable[[DataFrame], DataFrame]

# Attributes of the intermediate feeder and project rows.
FEEDER_FIELDS = (
    "voltage_kv_raw", "max_hosting_capacity_raw", "min_hosting_capacity_raw",
    "hca_refresh_date_raw", "color_code_raw", "shape_length_raw",
)
#: Optional: the shape of a feeder as text.
GEOMETRY = "geom_wkt"
#: Optional: a project's capacity as it was written.
RATING_TEXT = "nameplate_rating_raw"


def cleaned(df: DataFrame) -> DataFrame:
    return normalize_null_sentinels(drop_raw_tracking_columns(df))


def feeder_rows(native_id: str, fields: Mapping[str, str]) -> Layout:
    """One raw row per feeder; ``fields`` maps intermediate names, and GEOMETRY, to raw columns."""
    def layout(raw: DataFrame) -> DataFrame:
        df = cleaned(raw)
        return df.select(
            "utility_id",
            tenant_key(F.col("utility_id"), F.col(native_id)).alias("feeder_id"),
            F.col(native_id).alias("native_feeder_id"),
            *[optional_column(df, fields.get(f)).alias(f) for f in [*FEEDER_FIELDS, *_geometry(fields)]],
            *LINEAGE_COLUMNS,
        )

    return layout


def _geometry(fields: Mapping[str, str]) -> list[str]:
    return [GEOMETRY] if GEOMETRY in fields else []


def segment_rows(native_id: str, fields: Mapping[str, str]) -> Layout:
    """Many raw rows per feeder and delivery: capacities by mode, length by sum, refresh date by max, the rest
    by any value.

    A delivery is a whole of its own: segments that come again with a later one give a row of their
    own, and the history orders both."""
    by_mode = ("max_hosting_capacity_raw", "min_hosting_capacity_raw")
    by_any = ("voltage_kv_raw", "color_code_raw")

    def layout(raw: DataFrame) -> DataFrame:
        df = cleaned(raw)
        col = {f: optional_column(df, fields.get(f)) for f in FEEDER_FIELDS}
        rolled = rollup_segments(
            df.withColumn("native_feeder_id", F.col(native_id)),
            ["utility_id", "native_feeder_id", "pipeline_update_id"],
            mode={f: col[f] for f in by_mode},
            any_value={f: col[f] for f in by_any} | {g: optional_column(df, fields[g]) for g in _geometry(fields)},
            total={"shape_length_raw": to_double(col["shape_length_raw"])},
            latest={"hca_refresh_date_raw": col["hca_refresh_date_raw"]},
            earliest={c: F.col(c) for c in ("ingestion_timestamp", "ingestion_date")},
        )
        feeder_id = tenant_key(F.col("utility_id"), F.col("native_feeder_id"))
        return rolled.select(
            "utility_id", feeder_id.alias("feeder_id"), "native_feeder_id", *FEEDER_FIELDS, *_geometry(fields),
            *LINEAGE_COLUMNS,
        )

    return layout


def wide_projects(
    project: str, feeder: str, install_date: str | None = None, technologies: Sequence[str] = TECHNOLOGIES
) -> Layout:
    """One raw row per project with one capacity column per technology."""
    def layout(raw: DataFrame) -> DataFrame:
        df = cleaned(raw).withColumn("planned_installation_date_raw", optional_column(raw, install_date))
        ids = ["utility_id", project, feeder, "planned_installation_date_raw", *LINEAGE_COLUMNS]
        present = [t for t in technologies if t in df.columns]
        narrow = unpivot_positive(df, ids, present, "der_type", "nameplate_rating_kw")
        tenant = F.col("utility_id")
        return narrow.select(
            "utility_id",
            tenant_key(tenant, F.col(project), F.col("der_type")).alias("der_id"),
            tenant_key(tenant, F.col(feeder)).alias("feeder_id"),
            F.col(feeder).alias("native_feeder_id_raw"),
            "der_type",
            "nameplate_rating_kw",
            "planned_installation_date_raw",
            F.lit(None).cast("string").alias("interconnection_queue_id"),
            *LINEAGE_COLUMNS,
        )

    return layout


def narrow_projects(
    der_id: str, feeder: str, technology: str, capacity: str,
    install_date: str | None = None, queue_id: str | None = None,
) -> Layout:
    """One raw row per project and technology, the technology as text."""
    def layout(raw: DataFrame) -> DataFrame:
        df = cleaned(raw)
        return df.select(
            "utility_id",
            F.col(der_id).alias("der_id"),
            tenant_key(F.col("utility_id"), F.col(feeder)).alias("feeder_id"),
            F.col(feeder).alias("native_feeder_id_raw"),
            F.col(technology).alias("der_type"),
            to_double(F.col(capacity)).alias("nameplate_rating_kw"),
            F.col(capacity).alias(RATING_TEXT),
            optional_column(df, install_date).alias("planned_installation_date_raw"),
            optional_column(df, queue_id).alias("interconnection_queue_id"),
            *LINEAGE_COLUMNS,
        )

    return layout
