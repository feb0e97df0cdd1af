"""Rules, quality metrics and checks over order lines and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.operators import quality
from tierstone.sources.shared import shared_folder

RULES = {
    "has_tax": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_tax > 0 END",
    "small_discount": "l_discount <= 0.08",
    "known_status": "l_linestatus IN ('F', 'O')",
}
NOT_PASSED = {name: f"NOT coalesce({sql}, false)" for name, sql in RULES.items()}
FAILED_LIST = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in NOT_PASSED.items())
LINES = ["l_orderkey", "l_linenumber", "l_tax", "l_discount", "l_returnflag", "l_linestatus"]
LINES_SQL = ", ".join(LINES)


def lines(spark, sf):
    return table(spark, sf, "lineitem").select(*LINES)


@bound("rules_warn", f"SELECT {LINES_SQL}, concat_ws(',', {FAILED_LIST}) AS failed FROM lineitem")
def rules_warn(spark, sf):
    tagged = quality.tag_failures(lines(spark, sf), RULES)
    return tagged.select(*LINES, F.concat_ws(",", quality.FAILED).alias("failed"))


@bound("rules_drop", f"SELECT {LINES_SQL} FROM lineitem WHERE NOT ({' OR '.join(NOT_PASSED.values())})")
def rules_drop(spark, sf):
    return quality.expect_or_drop(lines(spark, sf), RULES)


@bound("rules_quarantine", f"""
SELECT {LINES_SQL}, CASE WHEN failed = '' THEN 'passed' ELSE failed END AS outcome
FROM (SELECT *, concat_ws(',', {FAILED_LIST}) AS failed FROM lineitem)""")
def rules_quarantine(spark, sf):
    path = shared_folder(spark, "quarantine")
    quality.write_with_quarantine(lines(spark, sf), RULES, path)
    stored = spark.read.parquet(path)
    good = quality.read_passed(stored).withColumn("outcome", F.lit("passed"))
    bad = quality.read_quarantined(stored).withColumn("outcome", F.concat_ws(",", quality.FAILED)).drop(quality.FAILED)
    return good.unionByName(bad)


@bound("rule_violations", " UNION ALL ".join(
    f"SELECT l_returnflag, '{name}' AS rule_name, count(*) AS checked, count(CASE WHEN {cond} THEN 1 END) AS failed "
    f"FROM lineitem GROUP BY 1" for name, cond in NOT_PASSED.items()
))
def rule_violations(spark, sf):
    return quality.violations(lines(spark, sf), RULES, by=["l_returnflag"])


EVENT_METRICS_SQL = """
SELECT event_type AS utility_id, CAST(ts AS DATE) AS ingestion_date, 'run_' || CAST(ts AS DATE) AS pipeline_update_id,
       count(*) AS total_records, count(CASE WHEN value < 1 AND event_type = 'view' THEN 1 END) AS null_key_count,
       count(CASE WHEN value < 5 THEN 1 END) AS negative_capacity_count,
       count(CASE WHEN value > 4 THEN 1 END) AS unresolved_feeder_count,
       CAST(NULL AS DATE) AS last_refresh_date, CAST(NULL AS INTEGER) AS days_since_refresh,
       'der_installed' AS table_name
FROM events GROUP BY 1, 2, 3
"""
REFRESH_LAG = "CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 8 WHEN '3-MEDIUM' THEN 20 ELSE 60 END"
ORDER_METRICS_SQL = f"""
SELECT o_orderpriority AS utility_id, DATE '2024-01-30' AS ingestion_date, 'run_orders' AS pipeline_update_id,
       count(*) AS total_records, count(CASE WHEN o_totalprice > 495000 THEN 1 END) AS null_key_count,
       count(CASE WHEN o_totalprice < 20000 THEN 1 END) AS negative_capacity_count,
       CAST(0 AS BIGINT) AS unresolved_feeder_count,
       max(CAST(o_orderdate AS DATE) - {REFRESH_LAG} + 8190) AS last_refresh_date,
       CAST(date_diff('day', max(CAST(o_orderdate AS DATE) - {REFRESH_LAG} + 8190), DATE '2024-01-30') AS INTEGER)
         AS days_since_refresh,
       'circuits' AS table_name
FROM orders GROUP BY 1
"""
METRIC_COLUMNS = (
    "utility_id, table_name, ingestion_date, pipeline_update_id, total_records, null_key_count, "
    "negative_capacity_count, unresolved_feeder_count, last_refresh_date, days_since_refresh"
)
METRICS_SQL = f"""
WITH e AS ({EVENT_METRICS_SQL}), o AS ({ORDER_METRICS_SQL}),
metrics AS (SELECT {METRIC_COLUMNS} FROM e UNION ALL SELECT {METRIC_COLUMNS} FROM o)
"""


def event_metrics(spark, sf):
    day, value = F.col("ts").cast("date"), F.col("value")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("utility_id"),
        day.alias("ingestion_date"),
        F.concat(F.lit("run_"), day).alias("pipeline_update_id"),
        F.when(~((value < 1) & (F.col("event_type") == "view")), F.col("event_id")).alias("der_id"),
        (value - 5).alias("nameplate_rating_kw"),
        F.when(value > 10, "").when(value <= 4, F.col("user_id").cast("string")).alias("feeder_id"),
    )
    return quality.quality_metrics(rows, "der_installed", "der_id", "nameplate_rating_kw", reference="feeder_id")


def order_metrics(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("utility_id"),
        F.lit("2024-01-30").cast("date").alias("ingestion_date"),
        F.lit("run_orders").alias("pipeline_update_id"),
        F.when(F.col("o_totalprice") <= 495000, F.col("o_orderkey")).alias("feeder_id"),
        (F.col("o_totalprice") - 20000).alias("max_hosting_capacity_mw"),
        F.expr(f"date_add(CAST(o_orderdate AS DATE), 8190 - {REFRESH_LAG})").alias("hca_refresh_date"),
    )
    as_of = F.lit("2024-01-30").cast("date")
    return quality.quality_metrics(
        rows, "circuits", "feeder_id", "max_hosting_capacity_mw", refreshed="hca_refresh_date", as_of=as_of
    )


def metrics(spark, sf):
    return event_metrics(spark, sf).unionByName(order_metrics(spark, sf))


@bound("quality_metrics", METRICS_SQL + "SELECT * FROM metrics")
def quality_metrics(spark, sf):
    return metrics(spark, sf)


@bound("key_uniqueness", """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def key_uniqueness(spark, sf):
    return quality.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@bound("records_per_source", "SELECT source, lang, count(*) AS record_count FROM documents GROUP BY 1, 2")
def records_per_source(spark, sf):
    return quality.records_per(table(spark, sf, "documents"), "source", "lang")


@bound("unregistered_tenants", """
SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS utility_id, count(*) AS record_count FROM customer
WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1""")
def unregistered_tenants(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.when(~(F.col("c_acctbal") < 0), F.col("c_mktsegment")).alias("utility_id")
    )
    return quality.unregistered_tenants(raw, ["BUILDING", "MACHINERY"])
