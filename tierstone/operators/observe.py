"""Monitoring over the metrics history: baselines, alerts, severity, dashboard rows.

The metrics history has one row per (tenant, table, run), so its windows stay small however large
the tables behind it are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.vocab import (
    AGING_DAYS,
    BASELINE_MIN_RUNS,
    BASELINE_ROWS,
    BASELINE_SIGMA,
    STALE_DAYS,
    UNRESOLVED_LOW,
    UNRESOLVED_MEDIUM,
    Z_EXTREME,
    Z_SIGNIFICANT,
)

SERIES = ("utility_id", "table_name")
ANOMALIES = ("ANOMALY_LOW", "ANOMALY_HIGH")


def baseline_stats(
    metrics: DataFrame,
    series: Sequence[str] = SERIES,
    day: str = "ingestion_date",
    run: str = "pipeline_update_id",
    value: str = "total_records",
    rows: int = BASELINE_ROWS,
    days: int | None = None,
) -> DataFrame:
    """Mean, sample deviation and count of the ``rows`` runs before each run, bounds and z-score.

    ``days`` counts calendar days before the run's day instead of rows.
    """
    if days is None:
        w = Window.partitionBy(*series).orderBy(day, run).rowsBetween(-rows, -1)
    else:
        w = Window.partitionBy(*series).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    avg, sd, x = F.col("baseline_avg"), F.col("baseline_stddev"), F.col(value)
    return metrics.withColumns({
        "baseline_avg": F.avg(value).over(w),
        "baseline_stddev": F.stddev_samp(value).over(w),
        "baseline_run_count": F.count("*").over(w),
    }).withColumns({
        "z_score": (x - avg) / F.nullif(sd, F.lit(0.0)),
        "lower_bound": avg - BASELINE_SIGMA * sd,
        "upper_bound": avg + BASELINE_SIGMA * sd,
    })


def volume_status(value: str = "total_records") -> Column:
    x = F.col(value)
    return (
        F.when(F.col("baseline_run_count") < BASELINE_MIN_RUNS, "INSUFFICIENT_BASELINE")
        .when(x < F.col("lower_bound"), "ANOMALY_LOW")
        .when(x > F.col("upper_bound"), "ANOMALY_HIGH")
        .otherwise("NORMAL")
    )


def volume_explanation(value: str = "total_records") -> Column:
    avg, x, status = F.col("baseline_avg"), F.col(value), F.col("status")

    def percent(difference: Column) -> Column:
        return F.round(difference / avg * 100, 1).cast("string")

    # The wording of the explanations.
    return (
        F.when(status == "INSUFFICIENT_BASELINE", "Need at least 3 historical runs to establish baseline")
        .when(
            status == "ANOMALY_LOW",
            F.concat(F.lit("⚠️  Record count below expected range ("), percent(avg - x), F.lit("% below baseline)")),
        )
        .when(
            status == "ANOMALY_HIGH",
            F.concat(F.lit("⚠️  Record count above expected range ("), percent(x - avg), F.lit("% above baseline)")),
        )
        .otherwise("✅ Within normal range")
    )


def volume_baseline(
    metrics: DataFrame,
    as_of: dt.date | None = None,
    series: Sequence[str] = SERIES,
    day: str = "ingestion_date",
    run: str = "pipeline_update_id",
    value: str = "total_records",
    rows: int = BASELINE_ROWS,
    days: int | None = None,
) -> DataFrame:
    """Each run judged against its rolling baseline.

    With ``as_of`` only that day's runs come out; they are judged by the same earlier runs as
    without it.  Later days never matter; with ``days``, days the baseline cannot reach don't go in.
    The day filter stays above the window: the window needs the earlier runs.
    """
    if as_of is not None:
        metrics = metrics.filter(F.col(day) <= F.lit(as_of))
        if days is not None:
            metrics = metrics.filter(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))
    judged = baseline_stats(metrics, series, day, run, value, rows, days)
    judged = judged.withColumn("status", volume_status(value)).withColumn("explanation", volume_explanation(value))
    if as_of is not None:
        judged = judged.filter(F.col(day) == F.lit(as_of))
    return judged.select(
        *series,
        F.col(value).alias("current_records"),
        F.round("baseline_avg", 0).alias("baseline_avg"),
        F.round("baseline_stddev", 2).alias("baseline_stddev"),
        F.round("lower_bound", 0).alias("lower_bound_2sigma"),
        F.round("upper_bound", 0).alias("upper_bound_2sigma"),
        F.round("z_score", 2).alias("z_score"),
        "baseline_run_count",
        "status",
        "explanation",
        day,
        run,
    )


def status_order() -> Column:
    """Report order of the volume statuses."""
    ladder = ("INSUFFICIENT_BASELINE", "ANOMALY_LOW", "ANOMALY_HIGH")
    out = None
    for i, s in enumerate(ladder, 1):
        out = F.when(F.col("status") == s, i) if out is None else out.when(F.col("status") == s, i)
    return out.otherwise(len(ladder) + 1)


def volume_alerts(judged: DataFrame) -> DataFrame:
    """Anomalies that have a sufficient baseline, low ones first."""
    hit = F.col("status").isin(*ANOMALIES) & (F.col("baseline_run_count") >= BASELINE_MIN_RUNS)
    return judged.filter(hit).orderBy(status_order(), *SERIES)


def alert_rollup(judged: DataFrame) -> DataFrame:
    """One row: number of anomalies and the affected ``tenant.table`` names in order.

    Reads the runs of one day, so the list is no longer than the number of monitored tables.
    """
    name = F.concat_ws(".", *SERIES)
    return judged.filter(F.col("status").isin(*ANOMALIES)).agg(
        F.count("*").alias("critical_anomaly_count"),
        F.concat_ws(", ", F.sort_array(F.collect_list(name))).alias("affected_tables"),
    )


def z_severity(z: Column) -> Column:
    size = F.abs(z)
    return F.when(size >= Z_EXTREME, "EXTREME").when(size >= Z_SIGNIFICANT, "SIGNIFICANT").otherwise("NORMAL")


def day_over_day(
    metrics: DataFrame, series: Sequence[str] = SERIES, day: str = "ingestion_date",
    run: str = "pipeline_update_id", value: str = "total_records",
) -> DataFrame:
    """Change of each run against the one before it."""
    previous = F.lag(value).over(Window.partitionBy(*series).orderBy(day, run))
    return metrics.select(
        *series, day, run, value,
        previous.alias("previous_records"),
        (F.col(value) - previous).alias("record_change"),
        F.round(100.0 * (F.col(value) - previous) / F.nullif(previous, F.lit(0)), 1).alias("change_pct"),
    )


def _on(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return metrics.filter(F.col("ingestion_date") == F.lit(as_of))


def null_key_alerts(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _on(metrics, as_of)
        .filter("null_key_count > 0")
        .select(*SERIES, "null_key_count", "ingestion_date", "pipeline_update_id")
        .orderBy(F.desc("null_key_count"), *SERIES)
    )


def stale_alerts(metrics: DataFrame, as_of: dt.date, table_name: str = "circuits") -> DataFrame:
    """Tables past the refresh limits; only ``table_name`` carries a refresh date."""
    age = F.col("days_since_refresh")
    # The severity labels of this report.
    severity = F.when(age > STALE_DAYS, "🔴 CRITICAL").when(age > AGING_DAYS, "🟠 HIGH").otherwise("✅ OK")
    return (
        _on(metrics, as_of)
        .filter((F.col("table_name") == table_name) & (age > AGING_DAYS))
        .select(*SERIES, "last_refresh_date", "days_since_refresh", severity.alias("severity"), "ingestion_date")
        .orderBy(age.desc(), *SERIES)
    )


def freshness_label(age: Column) -> Column:
    # The labels of the freshness tile.
    return F.when(age > STALE_DAYS, "STALE").when(age > AGING_DAYS, "AGING").otherwise("FRESH")


def unresolved_alerts(metrics: DataFrame, as_of: dt.date, limit: int = UNRESOLVED_MEDIUM) -> DataFrame:
    share = F.round(100.0 * F.col("unresolved_feeder_count") / F.col("total_records"), 1)
    return (
        _on(metrics, as_of)
        .filter(F.col("table_name").contains("der") & (F.col("unresolved_feeder_count") > limit))
        .select(
            *SERIES, "unresolved_feeder_count", "total_records", share.alias("unresolved_pct"), "ingestion_date"
        )
        .orderBy(F.desc("unresolved_pct"), *SERIES)
    )


def alert_severity(metrics: DataFrame, judged: DataFrame) -> DataFrame:
    """Every metrics row with one severity; quality, freshness and volume in one ladder."""
    run = [*SERIES, "ingestion_date", "pipeline_update_id"]
    status, age, unresolved = F.col("status"), F.col("days_since_refresh"), F.col("unresolved_feeder_count")
    severity = (
        F.when((F.col("null_key_count") > 0) | (age > STALE_DAYS), "CRITICAL")
        .when((status == "ANOMALY_LOW") | (age > AGING_DAYS), "HIGH")
        .when((status == "ANOMALY_HIGH") | (unresolved > UNRESOLVED_MEDIUM), "MEDIUM")
        .when(unresolved > UNRESOLVED_LOW, "LOW")
        .otherwise("OK")
    )
    return metrics.join(judged.select(*run, "status"), run, "left").select(
        *run, "total_records", "null_key_count", "unresolved_feeder_count", "days_since_refresh", "status",
        severity.alias("severity"),
    )


def metric_snapshot(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    return _on(metrics, as_of).orderBy(*SERIES)


def unresolved_by_table(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(*SERIES).agg(
        F.sum("unresolved_feeder_count").alias("unresolved"), F.sum("total_records").alias("total")
    )


def alerts_by_severity(severities: DataFrame) -> DataFrame:
    return severities.groupBy("ingestion_date", "severity").agg(F.count("*").alias("alert_count"))


def run_success(runs: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Runs per day with the share that succeeded, newest day first."""
    day = F.col("start_time").cast("date")
    ok = F.count_if(F.col("status") == "SUCCESS")
    return (
        runs.filter(day >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy(day.alias("run_date"))
        .agg(
            F.count("*").alias("total_runs"),
            ok.alias("successful_runs"),
            F.round(100.0 * ok / F.count("*"), 1).alias("success_rate"),
        )
        .orderBy(F.desc("run_date"))
    )
