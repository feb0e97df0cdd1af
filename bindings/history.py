"""Type-2 history: events per user (tracked: type) and orders per customer (tracked: priority)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.operators.history import as_of, as_of_join, filter_current, scd2_build, scd2_merge, snapshot_diff, unkeyed_rows
from tierstone.plans.flows import CIRCUITS, DER_INSTALLED, DER_PLANNED, HistoryFlow

EVENT_HISTORY = dict(
    keys=["user_id"], sequence="ts", tracked=["event_type"], drop=["props"], tiebreak=["event_id"]
)
VERSIONS_SQL = """
WITH d AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
c AS (
  SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) IS DISTINCT FROM event_type
                 THEN 1 ELSE 0 END AS opens FROM d),
v AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS version FROM c),
g AS (
  SELECT user_id, version, arg_max(event_id, ts) AS event_id, max(ts) AS ts, min(event_type) AS event_type,
         arg_max(value, ts) AS value, min(ts) AS start_at FROM v GROUP BY 1, 2),
history AS (
  SELECT user_id, event_id, ts, event_type, value, start_at AS "__START_AT",
         lead(start_at) OVER (PARTITION BY user_id ORDER BY version) AS "__END_AT" FROM g)
"""


def event_history(spark, sf, **kw):
    return scd2_build(table(spark, sf, "events"), **EVENT_HISTORY, **kw)


@bound("event_history", VERSIONS_SQL + "SELECT * FROM history")
def event_history_all(spark, sf):
    return event_history(spark, sf)


@bound("event_history_split_keys", VERSIONS_SQL + "SELECT * FROM history")
def event_history_split_keys(spark, sf):
    """The same with a task limit low enough that every user is cut into segments."""
    return event_history(spark, sf, rows_per_task=20)


@bound("event_history_split_text", VERSIONS_SQL.replace("SELECT * FROM events", "SELECT * REPLACE (lpad(CAST(epoch_us(ts) AS VARCHAR), 20, '0') AS ts) FROM events") + "SELECT * FROM history")
def event_history_split_text(spark, sf):
    """The sequence is a text, and every user is cut into segments."""
    events = table(spark, sf, "events")
    text = F.lpad(F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), 20, "0")
    return scd2_build(events.withColumn("ts", text), **EVENT_HISTORY, rows_per_task=20)


@bound("event_history_current", VERSIONS_SQL + 'SELECT * FROM history WHERE "__END_AT" IS NULL')
def event_history_current(spark, sf):
    return filter_current(event_history(spark, sf))


@bound("event_history_as_of", VERSIONS_SQL + """
SELECT * FROM history WHERE "__START_AT" <= TIMESTAMP '2024-01-15 00:00:00'
  AND ("__END_AT" > TIMESTAMP '2024-01-15 00:00:00' OR "__END_AT" IS NULL)""")
def event_history_as_of(spark, sf):
    return as_of(event_history(spark, sf), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


@bound("event_history_merge", VERSIONS_SQL + "SELECT * FROM history")
def event_history_merge(spark, sf):
    """Built on the first weeks without cheap events, then merged with everything else: later
    events and, for most users, late ones."""
    events = table(spark, sf, "events")
    first = (F.col("ts") < "2024-01-20") & (F.col("value") >= 10)
    target = scd2_build(events.filter(first), **EVENT_HISTORY)
    return scd2_merge(target, events.filter(~first), history=events, **EVENT_HISTORY)


@bound("event_history_merge_in_order", VERSIONS_SQL + "SELECT * FROM history")
def event_history_merge_in_order(spark, sf):
    """Nothing comes late, so the retained events are never read."""
    events = table(spark, sf, "events")
    target = scd2_build(events.filter("ts < '2024-01-20'"), **EVENT_HISTORY)
    return scd2_merge(target, events.filter("ts >= '2024-01-20'"), history=events, **EVENT_HISTORY)


@bound("orders_with_event_as_of", VERSIONS_SQL + """
SELECT o_orderkey, o_custkey AS user_id, m, event_type, value FROM (
  SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(o_orderkey % 50000 AS BIGINT)) AS m FROM orders) o
LEFT JOIN history h ON h.user_id = o.o_custkey AND h."__START_AT" <= o.m AND (h."__END_AT" > o.m OR h."__END_AT" IS NULL)""")
def orders_with_event_as_of(spark, sf):
    """Each order with what its customer's history said at a moment of the order's own; every customer is cut into segments."""
    m = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(o_orderkey % 50000 as int))")
    probes = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), m.alias("m"))
    return as_of_join(probes, "m", event_history(spark, sf), ["user_id"], ["event_type", "value"], rows_per_task=20)


@bound("event_history_every_change", """
SELECT user_id, event_id, ts, event_type, value, ts AS "__START_AT",
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)""")
def event_history_every_change(spark, sf):
    return event_history(spark, sf, untracked="version")


ORDER_FLOW = HistoryFlow(
    keys=("utility_id", "feeder_id"), sequence="day", tracked=("o_orderpriority", "o_orderstatus"),
    drop=("o_orderkey",), tiebreak=("o_orderkey",),
)
DAILY_ORDERS_SQL = """
WITH d AS (
  SELECT c_mktsegment AS utility_id, o_custkey AS feeder_id, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority, o_orderstatus, o_totalprice, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1)
"""


def customer_orders(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_mktsegment").alias("utility_id"), F.col("o_custkey").alias("feeder_id"),
        F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderkey",
    )


@bound("order_history", DAILY_ORDERS_SQL + """,
c AS (
  SELECT *, CASE WHEN lag(o_orderpriority || o_orderstatus) OVER (PARTITION BY feeder_id ORDER BY day)
                      IS DISTINCT FROM o_orderpriority || o_orderstatus THEN 1 ELSE 0 END AS opens FROM d),
v AS (SELECT *, sum(opens) OVER (PARTITION BY feeder_id ORDER BY day) AS version FROM c),
g AS (
  SELECT utility_id, feeder_id, version, max(day) AS day, min(o_orderpriority) AS o_orderpriority,
         min(o_orderstatus) AS o_orderstatus, arg_max(o_totalprice, day) AS o_totalprice, min(day) AS start_at
  FROM v GROUP BY 1, 2, 3)
SELECT utility_id, feeder_id, day, o_orderpriority, o_orderstatus, o_totalprice, start_at AS "__START_AT",
       lead(start_at) OVER (PARTITION BY feeder_id ORDER BY version) AS "__END_AT" FROM g""")
def order_history(spark, sf):
    return ORDER_FLOW.build(customer_orders(spark, sf))


@bound("order_history_close_missing", """
WITH d AS (
  SELECT c_mktsegment AS utility_id, o_custkey AS feeder_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS day, max(o_orderpriority) AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
snaps AS (SELECT utility_id, day, lead(day) OVER (PARTITION BY utility_id ORDER BY day) AS due
          FROM (SELECT DISTINCT utility_id, day FROM d)),
e AS (SELECT d.*, due FROM d JOIN snaps USING (utility_id, day)),
c AS (
  SELECT *, CASE WHEN lag(priority) OVER w IS DISTINCT FROM priority OR lag(due) OVER w IS DISTINCT FROM day
                 THEN 1 ELSE 0 END AS opens
  FROM e WINDOW w AS (PARTITION BY utility_id, feeder_id ORDER BY day)),
v AS (SELECT *, sum(opens) OVER (PARTITION BY utility_id, feeder_id ORDER BY day) AS version FROM c)
SELECT utility_id, feeder_id, max(day) AS day, min(priority) AS priority, min(day) AS "__START_AT",
       arg_max_null(due, day) AS "__END_AT"
FROM v GROUP BY utility_id, feeder_id, version""")
def order_history_close_missing(spark, sf):
    """Monthly snapshots per segment; a customer missing from the next one is closed there."""
    snapshots = customer_orders(spark, sf).groupBy(
        "utility_id", "feeder_id", F.trunc("day", "month").alias("day")
    ).agg(F.max("o_orderpriority").alias("priority"))
    return scd2_build(snapshots, ["utility_id", "feeder_id"], "day", ["priority"], close_missing=["utility_id"])


def flow_sql(keys, sequence, tracked, values):
    """Versions of orders under a flow's names; ``values`` says what each name is in the table."""
    named = ", ".join(f"{sql} AS {name}" for name, sql in values.items())
    own, kept = ", ".join(keys), ", ".join(f"min({t}) AS {t}" for t in tracked)
    mark = " || '|' || ".join(f"coalesce(CAST({t} AS VARCHAR), '')" for t in tracked)
    return f"""
WITH n AS (SELECT {named}, o_orderkey FROM orders),
d AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY {own}, {sequence} ORDER BY o_orderkey DESC) = 1),
c AS (SELECT *, CASE WHEN lag({mark}) OVER (PARTITION BY {own} ORDER BY {sequence}) IS DISTINCT FROM {mark}
                     THEN 1 ELSE 0 END AS opens FROM d),
v AS (SELECT *, sum(opens) OVER (PARTITION BY {own} ORDER BY {sequence}) AS version FROM c),
g AS (SELECT {own}, version, max({sequence}) AS {sequence}, {kept}, min({sequence}) AS "__START_AT" FROM v GROUP BY {own}, version)
SELECT * EXCLUDE (version), lead("__START_AT") OVER (PARTITION BY {own} ORDER BY version) AS "__END_AT" FROM g"""


def through_flow(spark, sf, flow, values):
    """Orders before 1998 built, then those from a year before on merged: half of them are known already."""
    orders = table(spark, sf, "orders")
    rows = orders.select(
        *[F.expr(sql.replace("VARCHAR", "STRING")).alias(name) for name, sql in values.items()], "o_orderdate",
        F.timestamp_seconds("o_orderkey").alias("ingestion_timestamp"), F.lit("r").alias("pipeline_update_id"),
    )
    old = rows.filter("o_orderdate < '1998-01-01'").drop("o_orderdate")
    new = rows.filter("o_orderdate >= '1997-01-01'").drop("o_orderdate")
    return flow.merge(flow.build(old), new, rows.drop("o_orderdate"))


CIRCUIT_VALUES = {
    "utility_id": "o_orderpriority", "feeder_id": "CAST(o_custkey AS VARCHAR)", "hca_refresh_date": "o_orderdate",
    "native_feeder_id": "CAST(o_custkey % 7 AS VARCHAR)", "voltage_kv": "CAST(o_orderkey % 2 AS DOUBLE)",
    "max_hosting_capacity_mw": "CAST(o_orderkey % 3 AS DOUBLE)", "min_hosting_capacity_mw": "CAST(NULL AS DOUBLE)",
    "color_code": "o_orderstatus", "color_hex": "CAST(NULL AS VARCHAR)", "color_name": "CAST(NULL AS VARCHAR)",
    "shape_length": "CAST(o_custkey AS DOUBLE)",
}
INSTALLED_VALUES = {
    "utility_id": "o_orderpriority", "der_id": "CAST(o_custkey AS VARCHAR)", "der_type": "o_orderstatus",
    "ingestion_date": "CAST(o_orderdate AS DATE)", "feeder_id": "CAST(o_orderkey % 3 AS VARCHAR)",
    "native_feeder_id_raw": "CAST(NULL AS VARCHAR)", "nameplate_rating_kw": "CAST(o_orderkey % 2 AS DOUBLE)",
}
PLANNED_VALUES = INSTALLED_VALUES | {
    "planned_installation_date": "CAST(CASE WHEN o_orderkey % 4 < 2 THEN '2025-06-15' END AS DATE)",
    "interconnection_queue_id": "CAST(o_custkey AS VARCHAR)",
}
for _name, _flow, _values in (
    ("flow_circuits", CIRCUITS, CIRCUIT_VALUES), ("flow_der_installed", DER_INSTALLED, INSTALLED_VALUES),
    ("flow_der_planned", DER_PLANNED, PLANNED_VALUES),
):
    bound(_name, flow_sql(_flow.keys, _flow.sequence, _flow.tracked, _values))(
        partial(through_flow, flow=_flow, values=_values)
    )


@bound("unkeyed_rows", """
SELECT l_returnflag, count(*) AS unkeyed FROM lineitem WHERE NOT l_tax > 0 OR NOT l_discount > 0 GROUP BY 1""")
def unkeyed(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_tax") > 0, F.col("l_orderkey")).alias("key"),
        F.when(F.col("l_discount") > 0, F.col("l_shipdate")).alias("seq"),
    )
    return unkeyed_rows(rows, ["key"], "seq").groupBy("l_returnflag").agg(F.count("*").alias("unkeyed"))


@bound("order_changes", """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'),
n AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW'),
b AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderkey AS ok, n.o_orderkey AS nk,
             o.o_orderstatus AS os, n.o_orderstatus AS ns, o.o_totalprice AS op, n.o_totalprice AS np
      FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey)
SELECT o_orderkey, os AS o_orderstatus, op AS o_totalprice, 'delete' AS _change_type FROM b WHERE nk IS NULL
UNION ALL SELECT o_orderkey, ns, np, 'insert' FROM b WHERE ok IS NULL
UNION ALL SELECT o_orderkey, os, op, 'update_pre' FROM b
  WHERE ok IS NOT NULL AND nk IS NOT NULL AND (os IS DISTINCT FROM ns OR op IS DISTINCT FROM np)
UNION ALL SELECT o_orderkey, ns, np, 'update_post' FROM b
  WHERE ok IS NOT NULL AND nk IS NOT NULL AND (os IS DISTINCT FROM ns OR op IS DISTINCT FROM np)""")
def order_changes(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderpriority <> '1-URGENT'")
    new = o.filter("o_orderpriority <> '5-LOW'").withColumn(
        "o_orderstatus", F.when(~(F.col("o_totalprice") > 400000), F.col("o_orderstatus"))
    )
    return snapshot_diff(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
