"""The canonical model: one typed projection per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions.cleaning import optional_column
from tierstone.functions.colours import color_hex, color_name
from tierstone.functions.parsing import (
    canonical_technology,
    date_by_tenant,
    grid_codes,
    timestamp_by_tenant,
    to_double,
)
from tierstone.vocab import LINEAGE_COLUMNS

#: Names of the columns whose text gave no value, on demand.
UNPARSED = "_unparsed"
#: Columns that are parsed, by table.
PARSED = {
    "circuits": ("voltage_kv", "max_hosting_capacity_mw", "min_hosting_capacity_mw", "hca_refresh_date", "shape_length"),
    "der_installed": ("nameplate_rating_kw",),
    "der_planned": ("nameplate_rating_kw", "planned_installation_date"),
}


def _unparsed(parsed: Mapping[str, tuple[Column, Column]]) -> Column:
    """The names of (text, value) pairs with a text and no value."""
    names = F.array(*[F.when(text.isNotNull() & value.isNull(), F.lit(n)) for n, (text, value) in parsed.items()])
    return F.filter(names, lambda n: n.isNotNull()).alias(UNPARSED)


def canonical_circuits(rows: DataFrame, refresh_formats: Mapping[str, str], unparsed: bool = False) -> DataFrame:
    """Typed feeder rows; ``refresh_formats`` maps a tenant to its timestamp pattern.  ``unparsed`` adds UNPARSED."""
    code = F.col("color_code_raw")
    refreshed = timestamp_by_tenant(F.col("hca_refresh_date_raw"), F.col("utility_id"), refresh_formats)
    texts = {
        "voltage_kv": "voltage_kv_raw", "max_hosting_capacity_mw": "max_hosting_capacity_raw",
        "min_hosting_capacity_mw": "min_hosting_capacity_raw", "shape_length": "shape_length_raw",
    }
    parsed = {n: (F.col(raw), to_double(F.col(raw))) for n, raw in texts.items()}
    parsed["hca_refresh_date"] = (F.col("hca_refresh_date_raw"), refreshed)
    return rows.select(
        "feeder_id",
        "utility_id",
        "native_feeder_id",
        *[parsed[n][1].alias(n) for n in PARSED["circuits"][:4]],
        code.alias("color_code"),
        color_hex(code).alias("color_hex"),
        color_name(code).alias("color_name"),
        parsed["shape_length"][1].alias("shape_length"),
        *[c.alias(n) for n, c in grid_codes(F.col("native_feeder_id")).items()],
        optional_column(rows, "geom_wkt").alias("geom_wkt"),
        *LINEAGE_COLUMNS,
        *([_unparsed(parsed)] if unparsed else []),
    )


def canonical_der(
    rows: DataFrame, status: str, free_text_tenants: Sequence[str], date_formats: Mapping[str, str], unparsed: bool = False
) -> DataFrame:
    """Typed project rows.  Free-text tenants get canonical technology names, unknown text passes
    through; only the planned table has an installation date.  ``unparsed`` adds UNPARSED."""
    technology = F.col("der_type")
    if free_text_tenants:
        technology = F.when(
            F.col("utility_id").isin(*free_text_tenants), canonical_technology(technology)
        ).otherwise(technology)
    rating = to_double(F.col("nameplate_rating_kw"))
    parsed = {"nameplate_rating_kw": (optional_column(rows, "nameplate_rating_raw"), rating)}
    planned = []
    if status == "planned":
        text = F.col("planned_installation_date_raw")
        parsed["planned_installation_date"] = (text, date_by_tenant(text, F.col("utility_id"), date_formats))
        planned = [parsed["planned_installation_date"][1].alias("planned_installation_date")]
    return rows.select(
        "utility_id",
        "der_id",
        "feeder_id",
        "native_feeder_id_raw",
        technology.alias("der_type"),
        rating.alias("nameplate_rating_kw"),
        F.lit(status).alias("der_status"),
        "interconnection_queue_id",
        *LINEAGE_COLUMNS,
        *planned,
        *([_unparsed(parsed)] if unparsed else []),
    )
