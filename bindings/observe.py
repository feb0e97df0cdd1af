"""Monitoring queries over the quality metrics of events (30 daily runs) and orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bindings import bound, table
from bindings.quality import METRICS_SQL, event_metrics, metrics
from tierstone.operators import observe

AS_OF = dt.date(2024, 1, 30)


def baseline_sql(frame: str, source: str = METRICS_SQL, table_name: str = "der_installed") -> str:
    """The judged runs; ``frame`` is the window frame of the baseline."""
    return source + f"""
, m AS (SELECT * FROM metrics WHERE table_name = '{table_name}'),
s AS (
  SELECT *, avg(total_records) OVER w AS a, stddev_samp(total_records) OVER w AS sd, count(*) OVER w AS n
  FROM m WINDOW w AS (PARTITION BY utility_id, table_name ORDER BY ingestion_date {frame})),
b AS (
  SELECT *, (total_records - a) / nullif(sd, 0) AS z, a - 2 * sd AS lo, a + 2 * sd AS hi FROM s),
j AS (
  SELECT *, CASE WHEN n < 3 THEN 'INSUFFICIENT_BASELINE' WHEN total_records < lo THEN 'ANOMALY_LOW'
                 WHEN total_records > hi THEN 'ANOMALY_HIGH' ELSE 'NORMAL' END AS status FROM b),
judged AS (
  SELECT utility_id, table_name, total_records AS current_records, round(a, 0) AS baseline_avg,
         round(sd, 2) AS baseline_stddev, round(lo, 0) AS lower_bound_2sigma, round(hi, 0) AS upper_bound_2sigma,
         round(z, 2) AS z_score, n AS baseline_run_count, status,
         CASE status WHEN 'INSUFFICIENT_BASELINE' THEN 'Need at least 3 historical runs to establish baseline'
              WHEN 'ANOMALY_LOW' THEN '⚠️  Record count below expected range ('
                   || CAST(round((a - total_records) / a * 100, 1) AS VARCHAR) || '% below baseline)'
              WHEN 'ANOMALY_HIGH' THEN '⚠️  Record count above expected range ('
                   || CAST(round((total_records - a) / a * 100, 1) AS VARCHAR) || '% above baseline)'
              ELSE '✅ Within normal range' END AS explanation,
         ingestion_date, pipeline_update_id
  FROM j)
"""


BASELINE_SQL = baseline_sql("ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING")


def judged(spark, sf, **kw):
    return observe.volume_baseline(event_metrics(spark, sf), **kw)


@bound("volume_baseline", BASELINE_SQL + "SELECT * FROM judged")
def volume_baseline(spark, sf):
    return judged(spark, sf)


@bound("volume_baseline_week", baseline_sql(
    "RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING") + "SELECT * FROM judged")
def volume_baseline_week(spark, sf):
    return judged(spark, sf, days=7)


@bound("volume_baseline_today", BASELINE_SQL + """
SELECT * FROM judged WHERE ingestion_date = DATE '2024-01-30'
ORDER BY CASE status WHEN 'INSUFFICIENT_BASELINE' THEN 1 WHEN 'ANOMALY_LOW' THEN 2 WHEN 'ANOMALY_HIGH' THEN 3 ELSE 4 END,
         utility_id, table_name""")
def volume_baseline_today(spark, sf):
    return judged(spark, sf, as_of=AS_OF).orderBy(observe.status_order(), *observe.SERIES)


def order_runs(spark, sf, step):
    """Years of runs: orders per priority and day, week or month."""
    o = table(spark, sf, "orders").withColumn("day", F.date_trunc(step, "o_orderdate").cast("date"))
    return o.groupBy(
        F.col("o_orderpriority").alias("utility_id"), F.lit("orders").alias("table_name"), F.col("day").alias("ingestion_date"),
        F.col("day").cast("string").alias("pipeline_update_id"),
    ).agg(F.count("*").alias("total_records"))


def order_runs_sql(step, frame, day=None):
    source = f"""
WITH metrics AS (
  SELECT o_orderpriority AS utility_id, 'orders' AS table_name, CAST(date_trunc('{step}', o_orderdate) AS DATE) AS ingestion_date,
         CAST(CAST(date_trunc('{step}', o_orderdate) AS DATE) AS VARCHAR) AS pipeline_update_id, count(*) AS total_records
  FROM orders GROUP BY 1, 2, 3, 4)"""
    only = f" WHERE ingestion_date = DATE '{day}'" if day else ""
    return baseline_sql(frame, source, "orders") + "SELECT * FROM judged" + only


#: Name, step of the runs, reach of the baseline, its window frame, a day to judge.
REACHES = (
    ("60_rows", "day", {"rows": 60}, "ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING", "1998-06-02"),
    ("60_days", "day", {"days": 60}, "RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING", "1998-06-02"),
    ("weekly", "week", {}, "ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING", "1998-06-01"),
)


def _bind_reach(name, step, reach, frame, day):
    @bound(f"volume_baseline_{name}", order_runs_sql(step, frame))
    def whole(spark, sf):
        return observe.volume_baseline(order_runs(spark, sf, step), **reach)

    @bound(f"volume_baseline_{name}_of_a_day", order_runs_sql(step, frame, day))
    def of_a_day(spark, sf):
        return observe.volume_baseline(order_runs(spark, sf, step), dt.date.fromisoformat(day), **reach)


for _reach in REACHES:
    _bind_reach(*_reach)


@bound("volume_alerts", BASELINE_SQL + """
SELECT * FROM judged WHERE status IN ('ANOMALY_LOW', 'ANOMALY_HIGH') AND baseline_run_count >= 3
ORDER BY CASE status WHEN 'ANOMALY_LOW' THEN 1 ELSE 2 END, utility_id""")
def volume_alerts(spark, sf):
    return observe.volume_alerts(judged(spark, sf))


@bound("alert_rollup", BASELINE_SQL + """
SELECT count(*) AS critical_anomaly_count,
       coalesce(string_agg(utility_id || '.' || table_name, ', ' ORDER BY utility_id || '.' || table_name), '')
         AS affected_tables
FROM judged WHERE status IN ('ANOMALY_LOW', 'ANOMALY_HIGH') AND ingestion_date = DATE '2024-01-30'""")
def alert_rollup(spark, sf):
    return observe.alert_rollup(judged(spark, sf, as_of=AS_OF))


@bound("z_severity", BASELINE_SQL + """
SELECT utility_id, ingestion_date, CASE WHEN abs(z) >= 3 THEN 'EXTREME' WHEN abs(z) >= 2 THEN 'SIGNIFICANT'
       ELSE 'NORMAL' END AS severity FROM j""")
def z_severity(spark, sf):
    stats = observe.baseline_stats(event_metrics(spark, sf))
    return stats.select("utility_id", "ingestion_date", observe.z_severity(F.col("z_score")).alias("severity"))


@bound("volume_trend", BASELINE_SQL + """
SELECT utility_id, table_name, ingestion_date, current_records, baseline_avg, lower_bound_2sigma, upper_bound_2sigma
FROM judged""")
def volume_trend(spark, sf):
    return judged(spark, sf).select(
        "utility_id", "table_name", "ingestion_date", "current_records", "baseline_avg",
        "lower_bound_2sigma", "upper_bound_2sigma",
    )


@bound("day_over_day", METRICS_SQL + """
, p AS (
  SELECT utility_id, table_name, ingestion_date, pipeline_update_id, total_records,
         lag(total_records) OVER (PARTITION BY utility_id, table_name ORDER BY ingestion_date) AS previous_records
  FROM metrics)
SELECT *, total_records - previous_records AS record_change,
       round(100.0::DOUBLE * (total_records - previous_records) / nullif(previous_records, 0), 1) AS change_pct FROM p""")
def day_over_day(spark, sf):
    return observe.day_over_day(metrics(spark, sf))


@bound("null_key_alerts", METRICS_SQL + """
SELECT utility_id, table_name, null_key_count, ingestion_date, pipeline_update_id FROM metrics
WHERE ingestion_date = DATE '2024-01-30' AND null_key_count > 0 ORDER BY null_key_count DESC""")
def null_key_alerts(spark, sf):
    return observe.null_key_alerts(metrics(spark, sf), AS_OF)


@bound("stale_alerts", METRICS_SQL + """
SELECT utility_id, table_name, last_refresh_date, days_since_refresh,
       CASE WHEN days_since_refresh > 45 THEN '🔴 CRITICAL' WHEN days_since_refresh > 30 THEN '🟠 HIGH' ELSE '✅ OK' END
         AS severity, ingestion_date
FROM metrics WHERE ingestion_date = DATE '2024-01-30' AND table_name = 'circuits' AND days_since_refresh > 30
ORDER BY days_since_refresh DESC""")
def stale_alerts(spark, sf):
    return observe.stale_alerts(metrics(spark, sf), AS_OF)


@bound("freshness", METRICS_SQL + """
SELECT utility_id, days_since_refresh, CASE WHEN days_since_refresh > 45 THEN 'STALE'
       WHEN days_since_refresh > 30 THEN 'AGING' ELSE 'FRESH' END AS freshness
FROM metrics WHERE table_name = 'circuits'""")
def freshness(spark, sf):
    rows = metrics(spark, sf).filter("table_name = 'circuits'")
    label = observe.freshness_label(F.col("days_since_refresh"))
    return rows.select("utility_id", "days_since_refresh", label.alias("freshness"))


@bound("unresolved_alerts", METRICS_SQL + """
SELECT utility_id, table_name, unresolved_feeder_count, total_records,
       round(100.0::DOUBLE * unresolved_feeder_count / total_records, 1) AS unresolved_pct, ingestion_date
FROM metrics WHERE ingestion_date = DATE '2024-01-30' AND table_name LIKE '%der%' AND unresolved_feeder_count > 30
ORDER BY unresolved_pct DESC""")
def unresolved_alerts(spark, sf):
    return observe.unresolved_alerts(metrics(spark, sf), AS_OF, limit=30)


SEVERITY_SQL = BASELINE_SQL + """
, severities AS (
  SELECT m.utility_id, m.table_name, m.ingestion_date, m.pipeline_update_id, m.total_records, m.null_key_count,
         m.unresolved_feeder_count, m.days_since_refresh, j.status,
         CASE WHEN m.null_key_count > 0 OR m.days_since_refresh > 45 THEN 'CRITICAL'
              WHEN j.status = 'ANOMALY_LOW' OR m.days_since_refresh > 30 THEN 'HIGH'
              WHEN j.status = 'ANOMALY_HIGH' OR m.unresolved_feeder_count > 1000 THEN 'MEDIUM'
              WHEN m.unresolved_feeder_count > 500 THEN 'LOW' ELSE 'OK' END AS severity
  FROM metrics m LEFT JOIN judged j ON m.utility_id = j.utility_id AND m.table_name = j.table_name
    AND m.ingestion_date = j.ingestion_date AND m.pipeline_update_id = j.pipeline_update_id)
"""


@bound("alert_severity", SEVERITY_SQL + "SELECT * FROM severities")
def alert_severity(spark, sf):
    return observe.alert_severity(metrics(spark, sf), judged(spark, sf))


@bound("alerts_by_severity", SEVERITY_SQL + """
SELECT ingestion_date, severity, count(*) AS alert_count FROM severities GROUP BY 1, 2""")
def alerts_by_severity(spark, sf):
    return observe.alerts_by_severity(observe.alert_severity(metrics(spark, sf), judged(spark, sf)))


@bound("metric_snapshot", METRICS_SQL + """
SELECT * FROM metrics WHERE ingestion_date = DATE '2024-01-30' ORDER BY utility_id, table_name""")
def metric_snapshot(spark, sf):
    return observe.metric_snapshot(metrics(spark, sf), AS_OF)


@bound("unresolved_by_table", METRICS_SQL + """
SELECT utility_id, table_name, CAST(sum(unresolved_feeder_count) AS BIGINT) AS unresolved,
       CAST(sum(total_records) AS BIGINT) AS total FROM metrics GROUP BY 1, 2""")
def unresolved_by_table(spark, sf):
    return observe.unresolved_by_table(metrics(spark, sf))


@bound("run_success", """
SELECT CAST(ts AS DATE) AS run_date, count(*) AS total_runs,
       count(CASE WHEN event_type <> 'error' THEN 1 END) AS successful_runs,
       round(100.0::DOUBLE * count(CASE WHEN event_type <> 'error' THEN 1 END) / count(*), 1) AS success_rate
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-05' GROUP BY 1 ORDER BY 1 DESC""")
def run_success(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("ts").alias("start_time"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status")
    )
    return observe.run_success(runs, dt.date(2024, 2, 4))
