"""Histories that are stored and merged run by run: events, orders and monthly snapshots of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import bound, table
from bindings.history import VERSIONS_SQL, customer_orders
from tierstone.plans.flows import HistoryFlow
from tierstone.sources.shared import shared_folder
from tierstone.sources.snapshots import SnapshotTable

EVENTS = HistoryFlow(keys=["user_id"], sequence="ts", tracked=["event_type"], drop=["props"], tiebreak=["event_id"])


def stored_events(spark, sf):
    """Three runs: the first weeks without cheap events, then what came late to every third user, then all the rest
    in order of time. Late users are rebuilt from the files of the retained runs that hold them."""
    events = table(spark, sf, "events")
    first, cheap = F.col("ts") < "2024-01-20", F.col("value") < 10
    runs = {"r0": events.filter(first & ~cheap), "r1": events.filter(first & cheap & (F.col("user_id") % 3 == 0)),
            "r2": events.filter(~(first & ~cheap) & ~(first & cheap & (F.col("user_id") % 3 == 0)))}
    own, retained = EVENTS.stored_in(shared_folder(spark, "history")), SnapshotTable(shared_folder(spark, "retained"))
    for run_id, rows in runs.items():
        retained.publish(rows, run_id, index_by=EVENTS.keys)
        EVENTS.take(spark, own, run_id, retained.read(spark, run_id), lambda k: retained.read_keys(spark, k, EVENTS.keys))
    return own


@bound("event_history_stored", VERSIONS_SQL + "SELECT * FROM history")
def event_history_stored(spark, sf):
    return stored_events(spark, sf).read(spark)


@bound("event_history_stored_current", VERSIONS_SQL + 'SELECT * EXCLUDE ("__END_AT") FROM history WHERE "__END_AT" IS NULL')
def event_history_stored_current(spark, sf):
    """After compaction, from the open part alone."""
    own = stored_events(spark, sf)
    own.compact(spark)
    return own.open_rows(spark).drop("__END_AT")


def state_sql(before: str) -> str:
    """The open version of each customer out of the orders before a day."""
    return f"""
  SELECT o_custkey, arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderstatus,
         arg_max(o_orderpriority, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderpriority
  FROM orders WHERE o_orderdate < '{before}' GROUP BY 1"""


@bound("order_change_log", f"""
WITH o AS ({state_sql('1995-01-01')}), n AS ({state_sql('1998-01-01')}),
b AS (SELECT n.o_custkey, o.o_custkey AS ok, o.o_orderstatus AS os, n.o_orderstatus AS ns, o.o_orderpriority AS op, n.o_orderpriority AS np
      FROM n LEFT JOIN o ON o.o_custkey = n.o_custkey)
SELECT o_custkey, ns AS o_orderstatus, np AS o_orderpriority, 'insert' AS _change_type FROM b WHERE ok IS NULL
UNION ALL SELECT o_custkey, os, op, 'update_pre' FROM b WHERE ok IS NOT NULL AND (os IS DISTINCT FROM ns OR op IS DISTINCT FROM np)
UNION ALL SELECT o_custkey, ns, np, 'update_post' FROM b WHERE ok IS NOT NULL AND (os IS DISTINCT FROM ns OR op IS DISTINCT FROM np)""")
def order_change_log(spark, sf):
    """What changed between two runs of four, out of the log that the merges wrote."""
    flow = HistoryFlow(keys=["o_custkey"], sequence="o_orderdate", tracked=["o_orderstatus", "o_orderpriority"], drop=["o_orderkey"], tiebreak=["o_orderkey"])
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_orderkey")
    own = flow.stored_in(shared_folder(spark, "history"))
    edges = ["1990-01-01", "1995-01-01", "1996-07-01", "1998-01-01", "2099-01-01"]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        rows = orders.filter((F.col("o_orderdate") >= a) & (F.col("o_orderdate") < b))
        flow.take(spark, own, f"r{i}", rows, lambda k: orders.join(k, "o_custkey", "left_semi"))
    return own.net_changes(spark, 0, 2, ["o_orderstatus", "o_orderpriority"])


MONTHLY = HistoryFlow(
    keys=["utility_id", "feeder_id"], sequence="day", tracked=["priority"], drop=[], tiebreak=[], close_missing=["utility_id"]
)


@bound("order_history_close_missing_stored", """
WITH d AS (
  SELECT c_mktsegment AS utility_id, o_custkey AS feeder_id,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS day, max(o_orderpriority) AS priority
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
def order_history_close_missing_stored(spark, sf):
    """Yearly snapshots per segment, taken in three runs: several at once, then one, then the last."""
    snapshots = customer_orders(spark, sf).groupBy("utility_id", "feeder_id", F.trunc("day", "year").alias("day")).agg(
        F.max("o_orderpriority").alias("priority")
    )
    own = MONTHLY.stored_in(shared_folder(spark, "history"))
    year = F.year("day")
    for i, part in enumerate([year <= 1996, year == 1997, year >= 1998]):
        MONTHLY.take(spark, own, f"r{i}", snapshots.filter(part), lambda s: snapshots.join(s, "utility_id", "left_semi"))
    return own.read(spark)
