"""Current-state tables for lookups, dashboards and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.operators.history import filter_current
from tierstone.operators.reshape import pivot_totals
from tierstone.operators.skew import dealt, rank_within, top_within
from tierstone.vocab import TECHNOLOGIES

FEEDER_KEY = ["feeder_id", "utility_id"]


def or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def current_der(installed: DataFrame, planned: DataFrame | None, extra: Sequence[str] = ()) -> DataFrame:
    """Open installed and planned rows in one frame, told apart by ``installation_status``.

    Without ``planned`` the first frame has rows of both kinds and that column already, and is read once.
    """
    columns = [*FEEDER_KEY, "nameplate_rating_kw", *extra]
    if planned is None:
        return filter_current(installed).select(*columns, "installation_status")
    tagged = [
        filter_current(df).select(*columns, F.lit(status).alias("installation_status"))
        for df, status in ((installed, "installed"), (planned, "planned"))
    ]
    return tagged[0].unionByName(tagged[1])


def status_totals(status: str, count_name: str, amount_name: str) -> list[Column]:
    hit = F.col("installation_status") == status
    return [
        F.count_if(hit).alias(count_name),
        F.sum(F.when(hit, F.col("nameplate_rating_kw"))).alias(amount_name),
    ]


def feeders_with_capacity(circuits: DataFrame, installed: DataFrame, planned: DataFrame) -> DataFrame:
    """One row per current feeder with its load and what is left of its hosting capacity.

    Both statuses are summed in a single aggregate before the join, so projects are shuffled once
    as partial sums and the feeder side meets one row per key.  Rows without a feeder match
    nothing and drop out.
    """
    load = (
        current_der(installed, planned)
        .groupBy(*FEEDER_KEY)
        .agg(
            *status_totals("installed", "installed_der_count", "installed_capacity_kw"),
            *status_totals("planned", "planned_der_count", "planned_capacity_kw"),
        )
    )
    installed_kw, planned_kw = or_zero("installed_capacity_kw"), or_zero("planned_capacity_kw")
    installed_n, planned_n = or_zero("installed_der_count"), or_zero("planned_der_count")
    return (
        filter_current(circuits)
        .join(load, FEEDER_KEY, "left")
        .select(
            *FEEDER_KEY,
            "native_feeder_id",
            "voltage_kv",
            "max_hosting_capacity_mw",
            "min_hosting_capacity_mw",
            installed_n.alias("installed_der_count"),
            installed_kw.alias("installed_capacity_kw"),
            planned_n.alias("planned_der_count"),
            planned_kw.alias("planned_capacity_kw"),
            (installed_n + planned_n).alias("total_der_count"),
            (installed_kw + planned_kw).alias("total_der_capacity_kw"),
            (F.col("max_hosting_capacity_mw") - (installed_kw + planned_kw) / 1000).alias("available_capacity_mw"),
            "color_code",
            "color_hex",
            "color_name",
            "shape_length",
            F.col("hca_refresh_date").alias("capacity_as_of_date"),
        )
    )


def feeder_der_summary(
    installed: DataFrame, planned: DataFrame | None = None, technologies: Sequence[str] = TECHNOLOGIES
) -> DataFrame:
    """Counts and capacity per feeder, by status and by technology; for one frame of both see :func:`current_der`.

    Rows shrink to at most one per feeder and technology before the wide pivot, so the two
    columns per technology never travel through a shuffle of raw rows.  Distinct projects are
    counted apart on the bare (feeder, project) pairs and added as one more row per feeder: one
    distinct in the wide aggregate would carry every sum once per project.
    """
    der = current_der(installed, planned, extra=["der_id", "der_type"]).filter("feeder_id IS NOT NULL")

    def of_status(status: str) -> list[Column]:
        hit = F.col("installation_status") == status
        return [
            F.count_if(hit).alias(f"{status}_n"),
            F.sum(F.when(hit, F.col("nameplate_rating_kw")).otherwise(0)).alias(f"{status}_kw"),
        ]

    per_technology = der.groupBy(*FEEDER_KEY, "der_type").agg(
        F.count("*").alias("n"),
        F.sum("nameplate_rating_kw").alias("kw"),
        *of_status("installed"),
        *of_status("planned"),
    )
    projects = (
        der.select(*FEEDER_KEY, "der_id").distinct().groupBy(*FEEDER_KEY).agg(F.count("der_id").alias("projects"))
    )
    return (
        per_technology.unionByName(projects, allowMissingColumns=True)
        .repartition(*FEEDER_KEY)
        .groupBy(*FEEDER_KEY)
        .agg(
            F.sum("n").alias("total_der_count"),
            F.sum("projects").alias("unique_project_count"),
            F.sum("installed_n").alias("installed_count"),
            F.sum("installed_kw").alias("installed_capacity_kw"),
            F.sum("planned_n").alias("planned_count"),
            F.sum("planned_kw").alias("planned_capacity_kw"),
            *pivot_totals("der_type", technologies, "n", "kw"),
            F.count("der_type").alias("technology_type_count"),
        )
        .withColumn("has_hybrid_projects", F.col("technology_type_count") > 1)
    )


def feeder_map_layer(circuits: DataFrame, der_summary: DataFrame) -> DataFrame:
    """Everything a map needs per current feeder, without a further join."""
    summary = der_summary.select(
        *FEEDER_KEY, "installed_count", "planned_count", "installed_capacity_kw", "planned_capacity_kw"
    )
    refreshed = F.col("hca_refresh_date")
    level = (
        F.when(F.col("geom_wkt").isNotNull(), "geometry")
        .when(F.col("grid_area_code").isNotNull(), "district")
        .otherwise("point_fallback")
    )
    left_mw = (
        F.col("max_hosting_capacity_mw") - or_zero("installed_capacity_kw") / 1000 - or_zero("planned_capacity_kw") / 1000
    )
    return (
        filter_current(circuits)
        .join(summary, FEEDER_KEY, "left")
        .select(
            *FEEDER_KEY,
            "native_feeder_id",
            "grid_state_code",
            "grid_area_code",
            "grid_circuit_id",
            "color_code",
            "color_hex",
            "color_name",
            "max_hosting_capacity_mw",
            "min_hosting_capacity_mw",
            left_mw.alias("available_capacity_mw"),
            or_zero("installed_count").alias("installed_der_count"),
            or_zero("planned_count").alias("planned_der_count"),
            or_zero("installed_capacity_kw").alias("total_installed_capacity_kw"),
            or_zero("planned_capacity_kw").alias("total_planned_capacity_kw"),
            "geom_wkt",
            level.alias("map_render_level"),
            refreshed.alias("capacity_as_of_date"),
            refreshed.alias("data_as_of_date"),
        )
    )


def with_min_capacity(feeders: DataFrame, min_mw: float, utility_id: str | None = None) -> DataFrame:
    """Feeders with at least ``min_mw`` available, optionally of one tenant."""
    hit = F.col("available_capacity_mw") >= min_mw
    return feeders.filter(hit if utility_id is None else hit & (F.col("utility_id") == utility_id))


def with_available_capacity(feeders: DataFrame) -> DataFrame:
    return feeders.filter("available_capacity_mw > 0")


def map_slice(layer: DataFrame, utility_id: str, area_codes: Sequence[int]) -> DataFrame:
    return layer.filter((F.col("utility_id") == utility_id) & F.col("grid_area_code").isin(*area_codes))


def der_of_feeder(installed: DataFrame, planned: DataFrame, feeder_id: str) -> DataFrame:
    """Current projects of one feeder, both statuses."""
    rows = current_der(installed, planned, extra=["der_id", "der_type"])
    return rows.filter(F.col("feeder_id") == feeder_id)


def technology_distribution(installed: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Projects and capacity per technology and status over all feeders; for one frame of both see :func:`current_der`."""
    return (
        current_der(installed, planned, extra=["der_type"])
        .groupBy("der_type", "installation_status")
        .agg(F.count("*").alias("der_count"), F.sum("nameplate_rating_kw").alias("capacity_kw"))
    )


def rank_by_capacity(feeders: DataFrame) -> DataFrame:
    """Every feeder with its rank by available capacity inside its tenant."""
    return rank_within(feeders, ["utility_id"], "available_capacity_mw", "capacity_rank")


def top_by_capacity(feeders: DataFrame, k: int) -> DataFrame:
    """The ``k`` best ranks per tenant, ties included; see :func:`skew.top_within`."""
    return top_within(feeders, ["utility_id"], "available_capacity_mw", k, "capacity_rank")


def project_id(der_id: Column) -> Column:
    """The project part of ``project_technology``: everything before the last underscore."""
    return F.regexp_replace(der_id, r"_[^_]*$", "")


def hybrid_projects(der: DataFrame, rows: int = 0) -> DataFrame:
    """Projects with more than one technology; ``rows``, about how many there are in ``der``, sizes the tasks."""
    named = der.select("utility_id", project_id(F.col("der_id")).alias("project_id"), "der_type")
    return (
        dealt(named, ["utility_id", "project_id"], rows)
        .groupBy("utility_id", "project_id")
        .agg(F.count_distinct("der_type").alias("technology_count"))
        .filter("technology_count > 1")
    )


def project_counts(der: DataFrame) -> DataFrame:
    """Rows against projects per feeder: a hybrid project has one row per technology."""
    return (
        der.filter("feeder_id IS NOT NULL")
        .groupBy(*FEEDER_KEY)
        .agg(
            F.count("*").alias("der_rows"),
            F.count_distinct(project_id(F.col("der_id"))).alias("project_count"),
        )
    )


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key is set but has no parent row; unresolved keys are another matter, see
    :func:`unresolved`."""
    known = parent.select(*keys).distinct()
    return child.dropna(subset=list(keys)).join(known, list(keys), "left_anti")


def unresolved(child: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return child.filter(missing)
