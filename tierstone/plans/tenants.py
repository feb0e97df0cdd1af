"""Two example tenants: segment/wide files and feeder/narrow files."""

from __future__ import annotations

from tierstone.plans.layouts import feeder_rows, narrow_projects, segment_rows, wide_projects
from tierstone.plans.registry import Tenant, TenantRegistry

# Column names and date patterns of the two delivered file formats.
SEGMENT_CIRCUITS = segment_rows("Circuits_Phase3_CIRCUIT", {
    "voltage_kv_raw": "NYHCPV_csv_FVOLTAGE",
    "max_hosting_capacity_raw": "NYHCPV_csv_FMAXHC",
    "min_hosting_capacity_raw": "NYHCPV_csv_FMINHC",
    "hca_refresh_date_raw": "NYHCPV_csv_FHCADATE",
    "color_code_raw": "NYHCPV_csv_NMAPCOLOR",
    "shape_length_raw": "Shape_Length",
})
FEEDER_CIRCUITS = feeder_rows("Master_CDF", {
    "voltage_kv_raw": "feeder_voltage",
    "max_hosting_capacity_raw": "feeder_max_hc",
    "min_hosting_capacity_raw": "feeder_min_hc",
    "hca_refresh_date_raw": "hca_refresh_date",
    "color_code_raw": "color",
    "shape_length_raw": "Shape_Length",
})
WIDE_INSTALLED = wide_projects("ProjectID", "ProjectCircuitID")
WIDE_PLANNED = wide_projects("ProjectID", "ProjectCircuitID", install_date="InServiceDate")
NARROW_INSTALLED = narrow_projects(
    "DER_ID", "DER_INTERCONNECTION_LOCATION", "DER_TYPE", "DER_NAMEPLATE_RATING"
)
NARROW_PLANNED = narrow_projects(
    "INTERCONNECTION_QUEUE_REQUEST_ID", "DER_INTERCONNECTION_LOCATION", "DER_TYPE", "DER_NAMEPLATE_RATING",
    install_date="PLANNED_INSTALLATION_DATE", queue_id="INTERCONNECTION_QUEUE_REQUEST_ID",
)
ZONED_DASHES = "yyyy-MM-dd HH:mm:ssXXX"
ZONED_SLASHES = "yyyy/MM/dd HH:mm:ssX"
US_DATE = "M/d/yyyy"


def segment_tenant(utility_id: str) -> Tenant:
    return Tenant(utility_id, SEGMENT_CIRCUITS, WIDE_INSTALLED, WIDE_PLANNED, refresh_format=ZONED_DASHES)


def feeder_tenant(utility_id: str) -> Tenant:
    return Tenant(
        utility_id, FEEDER_CIRCUITS, NARROW_INSTALLED, NARROW_PLANNED,
        refresh_format=ZONED_SLASHES, install_date_format=US_DATE, free_text_types=True,
    )


def example_registry() -> TenantRegistry:
    return TenantRegistry().register(segment_tenant("utility1")).register(feeder_tenant("utility2"))
