"""Files: CSV drops written from the tables, streamed in, audited, published and clustered.

Each query writes under the shared folder first; what it writes is the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.context import RunContext
from tierstone.operators import quality
from tierstone.sources.audit import audit_rows, file_audit
from tierstone.sources.csv_drops import LONG_ROW
from tierstone.sources.layout import read_within, write_clustered, write_interleaved
from tierstone.sources.shared import shared_folder
from tierstone.sources.snapshots import SnapshotTable
from tierstone.streaming.ingest import ANY_AGE, RawTable, append_new_files, ingest_new_files
from tierstone.streaming.relay import append_metrics, follow_runs

RUN = RunContext("run_20240130_000000_00000001", dt.datetime(2024, 1, 30))


def land_customers(spark, sf, landing):
    """Customers as CSV: one folder per segment, three different headers.

    BUILDING has an unnamed index column first, MACHINERY writes ``balance`` in lower case and
    has a column of its own, the others have the plain header.
    """
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Key"), F.concat(F.lit('say "'), F.col("c_name"), F.lit('", please')).alias("Name"),
        F.col("c_acctbal").alias("Balance"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("s"),
    )
    shapes = {
        "BUILDING": [F.col("nation").alias(""), "Key", "Name", "Balance"],
        "MACHINERY": ["Name", F.col("Balance").alias("balance"), F.col("nation").alias("Nation"), "Key"],
    }
    for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        rows = c.filter(F.col("s") == segment).select(*shapes.get(segment, ["Key", "Name", "Balance"]))
        rows.write.options(header=True, quote='"', escape='"').csv(f"{landing}/{segment}/circuits")


def raw_customers(spark, sf, evolve=True):
    base = shared_folder(spark, "drops")
    landing = f"{base}/landing"
    land_customers(spark, sf, landing)
    raw = RawTable(f"{base}/raw", "circuits", ["Key", "Name", "Balance"], evolve=evolve)
    ingest_new_files(spark, landing, raw, f"{base}/checkpoint", RUN)
    ingest_new_files(spark, landing, raw, f"{base}/checkpoint", RUN)  # nothing new: nothing happens
    return base, raw


@bound("csv_ingest", """
SELECT CAST(c_custkey AS VARCHAR) AS "Key", 'say "' || c_name || '", please' AS "Name",
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance_kept,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal END AS balance_rescued,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_nationkey AS VARCHAR) END AS "Nation",
       c_mktsegment = 'BUILDING' AS _index_col_dropped, c_mktsegment AS utility_id,
       'run_20240130_000000_00000001' AS pipeline_update_id, DATE '2024-01-30' AS ingestion_date
FROM customer""")
def csv_ingest(spark, sf):
    """A column nobody knew becomes a column, a casing variant goes to rescued data, an index
    column is cleared and flagged."""
    _, raw = raw_customers(spark, sf)
    rescued = F.from_json("_rescued_data", "map<string,string>")
    return raw.read(spark).select(
        "Key", "Name",
        F.col("Balance").cast("double").alias("balance_kept"),
        F.try_element_at(rescued, F.lit("balance")).cast("double").alias("balance_rescued"),
        "Nation", "_index_col_dropped", "utility_id", "pipeline_update_id", "ingestion_date",
    )


@bound("schema_drift", """
SELECT c_mktsegment AS utility_id, 'schema_drift_detected' AS rule_name, count(*) AS checked,
       count(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END) AS failed
FROM customer GROUP BY 1""")
def schema_drift(spark, sf):
    """Without evolution the new column is drift, and the warning counts its rows."""
    _, raw = raw_customers(spark, sf, evolve=False)
    rule = {"schema_drift_detected": "_rescued_data IS NULL OR _rescued_data = ''"}
    return quality.violations(raw.read(spark), rule, by=["utility_id"])


@bound("file_audit", """
SELECT o_orderpriority AS utility_id, 'orders' AS dataset_type, 'SUCCEEDED' AS status, count(DISTINCT o_custkey) AS files,
       CAST(sum(had) AS BIGINT) AS with_artifact
FROM (SELECT o_orderpriority, o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS had
      FROM orders GROUP BY 1, 2) GROUP BY 1
UNION ALL
SELECT l_returnflag, 'lines', 'SUCCEEDED', count(DISTINCT l_suppkey), CAST(0 AS BIGINT) FROM lineitem GROUP BY 1""")
def audit(spark, sf):
    """Orders and lines as raw rows whose source file is named after the customer or supplier."""
    def raw(df, tenant, name, flag):
        path = F.concat(F.lit("/landing/"), F.col(tenant), F.lit("/f/"), F.col(name), F.lit(".csv"))
        return df.select(
            path.alias("source_file"), F.sha2(path, 256).alias("file_signature"), F.col(tenant).alias("utility_id"),
            RUN.timestamp().alias("ingestion_timestamp"), F.lit(RUN.run_id).alias("pipeline_update_id"),
            flag.alias("_index_col_dropped"),
        )

    files = file_audit({
        "orders": raw(table(spark, sf, "orders"), "o_orderpriority", "o_custkey", F.col("o_orderstatus") == "F"),
        "lines": raw(table(spark, sf, "lineitem"), "l_returnflag", "l_suppkey", F.lit(False)),
    })
    return files.groupBy("utility_id", "dataset_type", "status").agg(
        F.count("*").alias("files"), F.sum("had_index_column_artifact").alias("with_artifact")
    )


@bound("file_audit_stream", """
SELECT o_orderpriority AS utility_id, count(DISTINCT o_custkey) AS files,
       min(first_at) AS first_seen
FROM (SELECT o_orderpriority, o_custkey, min(CASE WHEN o_orderkey % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-03-01' END) AS first_at
      FROM orders GROUP BY 1, 2) GROUP BY 1""")
def audit_stream(spark, sf):
    """Audit rows of orders streamed in three drops: many repeat a signature, the second drop is two months older
    than the first, the third repeats the first."""
    base = shared_folder(spark, "audit")
    path = F.concat(F.lit("/landing/"), F.col("o_orderpriority"), F.lit("/f/"), F.col("o_custkey"), F.lit(".csv"))
    at = F.when(F.col("o_orderkey") % 2 == 0, F.lit(dt.datetime(2024, 1, 1))).otherwise(F.lit(dt.datetime(2024, 3, 1)))
    raw = table(spark, sf, "orders").select(
        path.alias("source_file"), F.sha2(path, 256).alias("file_signature"), F.col("o_orderpriority").alias("utility_id"),
        at.alias("ingestion_timestamp"), F.lit(RUN.run_id).alias("pipeline_update_id"), F.lit(False).alias("_index_col_dropped"),
    )
    rows = audit_rows(raw, "orders")
    late = F.col("ingestion_timestamp") < F.lit(dt.datetime(2024, 2, 1))
    for drop in (~late, late, ~late):
        rows.filter(drop).write.mode("append").parquet(f"{base}/rows")
        stream = spark.readStream.option("maxFileAge", ANY_AGE).schema(rows.schema).parquet(f"{base}/rows")
        append_new_files(stream, f"{base}/files", f"{base}/checkpoint")
    files = spark.read.parquet(f"{base}/files")
    seen = rows.groupBy("file_signature").agg(F.min("ingestion_timestamp").cast("date").alias("first_seen"))
    return files.join(seen, "file_signature").groupBy("utility_id").agg(
        F.count("*").alias("files"), F.min("first_seen").alias("first_seen")
    )


@bound("odd_drops", """
SELECT c_mktsegment || CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN ' [1] 20%' ELSE '' END AS utility_id,
       count(CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1 END) AS n,
       CAST(sum(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END) AS BIGINT) AS key_sum,
       CAST(sum(CASE WHEN c_mktsegment = 'FURNITURE' THEN c_nationkey END) AS BIGINT) AS rescued_batch_ids,
       count(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 END) AS long_rows, true AS audited
FROM customer GROUP BY c_mktsegment""")
def odd_drops(spark, sf):
    """Files that are not perfect: glob characters in the path, columns named like the pipeline's own, rows with more
    cells than the header, a header without rows."""
    base = shared_folder(spark, "odd")
    c = table(spark, sf, "customer")
    key, name = F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name")
    clash = [F.col("c_nationkey").alias("batch_id"), F.lit("zz").alias("utility_id")]
    shapes = {
        "AUTOMOBILE": ("AUTOMOBILE [1] 20%", [key, name], {}),
        "BUILDING": ("BUILDING", [key, name], {}),
        "FURNITURE": ("FURNITURE", [key, *clash, name], {}),
        "HOUSEHOLD": ("HOUSEHOLD", [key, F.concat("c_name", F.lit(",more,cells")).alias("Name")], {"quote": "\0"}),
        "MACHINERY": ("MACHINERY", [key, name], {}),
    }
    for segment, (folder, columns, options) in shapes.items():
        rows = c.filter((F.col("c_mktsegment") == segment) & F.lit(segment != "MACHINERY"))
        rows.select(*columns).write.options(header=True, **options).csv(f"{base}/landing/{folder}/circuits")
    raw = RawTable(f"{base}/raw", "circuits", ["Key", "Name"])
    for _ in range(2):
        ingest_new_files(spark, f"{base}/landing", raw, f"{base}/checkpoint", RUN)
    rescued = F.from_json("_rescued_data", "map<string,string>")
    rows = raw.read(spark).groupBy("utility_id").agg(
        F.count("*").alias("n"), F.sum(F.col("Key").cast("bigint")).alias("key_sum"),
        F.sum(F.try_element_at(rescued, F.lit("batch_id")).cast("bigint")).alias("rescued_batch_ids"),
        F.count(F.try_element_at(rescued, F.lit(LONG_ROW))).alias("long_rows"),
    )
    audited = raw.read_audit(spark).select("utility_id").distinct()
    return audited.join(rows, "utility_id", "left").select(
        "utility_id", F.coalesce("n", F.lit(0)).alias("n"), "key_sum", "rescued_batch_ids",
        F.coalesce("long_rows", F.lit(0)).alias("long_rows"), F.lit(True).alias("audited"),
    )


@bound("raw_stream_chain", """
SELECT c_mktsegment AS utility_id, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer GROUP BY 1""")
def raw_stream_chain(spark, sf):
    """One stream reads what another wrote."""
    base, raw = raw_customers(spark, sf)
    query = (
        raw.read_stream(spark).select("utility_id", F.col("Key").cast("bigint").alias("key"))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/chain-checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/chain")
    )
    query.awaitTermination()
    rows = spark.read.schema("utility_id string, key bigint").parquet(f"{base}/chain")
    return rows.groupBy("utility_id").agg(F.count("*").alias("n"), F.sum("key").alias("key_sum"))


def published_orders(spark, sf):
    """Two published runs of the orders table: before and from 1998-01-01 on in addition."""
    snapshots = SnapshotTable(shared_folder(spark, "orders"))
    o = table(spark, sf, "orders")
    snapshots.publish(o.filter("o_orderdate < '1998-01-01'"), "r1")
    snapshots.publish(o, "r2")
    return snapshots


@bound("snapshot_latest", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def snapshot_latest(spark, sf):
    snapshots = published_orders(spark, sf)
    snapshots.publish(table(spark, sf, "orders").filter("false"), "r2")  # already published: stays as it is
    return snapshots.read(spark).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@bound("snapshot_feed", """
SELECT 'r1' AS run, o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 2
UNION ALL SELECT 'r2', o_orderstatus, count(*) FROM orders GROUP BY 2""")
def snapshot_feed(spark, sf):
    """Every published run is handed on once, although each one replaces the table."""
    snapshots, base = published_orders(spark, sf), shared_folder(spark, "feed")

    def handle(rows, run_id):
        rows.select(F.lit(run_id).alias("run"), "o_orderstatus").write.mode("overwrite").parquet(f"{base}/out/of={run_id}")

    for _ in range(2):
        follow_runs(spark, snapshots, f"{base}/checkpoint", handle)
    return spark.read.parquet(f"{base}/out").groupBy("run", "o_orderstatus").agg(F.count("*").alias("n"))


@bound("stream_metrics", """
WITH r AS (SELECT 'r1' AS pipeline_update_id, * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
           UNION ALL SELECT 'r2', * FROM orders)
SELECT o_orderpriority AS utility_id, pipeline_update_id, count(*) AS total_records,
       count(CASE WHEN o_totalprice < 20000 THEN 1 END) AS negative_capacity_count FROM r GROUP BY 1, 2""")
def stream_metrics(spark, sf):
    """Metrics appended per run, without a watermark and without splitting a run."""
    snapshots, base = published_orders(spark, sf), shared_folder(spark, "metrics")

    def measure(rows):
        named = rows.select(
            F.col("o_orderpriority").alias("utility_id"), F.col("o_orderkey").alias("key"),
            (F.col("o_totalprice") - 20000).alias("measure"), F.lit(None).cast("date").alias("ingestion_date"),
            F.lit(None).cast("string").alias("pipeline_update_id"),
        )
        return quality.quality_metrics(named, "orders", "key", "measure")

    append_metrics(spark, snapshots, f"{base}/checkpoint", f"{base}/out", measure)
    return spark.read.parquet(f"{base}/out").select(
        "utility_id", F.col("run_id").alias("pipeline_update_id"), "total_records", "negative_capacity_count"
    )


@bound("clustered_lookup", """
SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2""")
def clustered_lookup(spark, sf):
    """A table clustered by (flag, supplier) and looked up by flag."""
    path = f"{shared_folder(spark, 'clustered')}/lines"
    write_clustered(table(spark, sf, "lineitem"), path, ["l_returnflag", "l_suppkey"])
    hit = spark.read.parquet(path).filter("l_returnflag = 'R'")
    return hit.groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))


@bound("interleaved_lookup", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity FROM lineitem
WHERE l_suppkey BETWEEN 3 AND 7 AND l_shipdate >= '1995-03-01' AND l_shipdate <= '1995-12-31'""")
def interleaved_lookup(spark, sf):
    """A table along a curve of (order, supplier, day), looked up by the second and third column."""
    import datetime as dt

    path = f"{shared_folder(spark, 'interleaved')}/lines"
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    write_interleaved(lines, path, ["l_orderkey", "l_suppkey", "l_shipdate"])
    return read_within(spark, path, {"l_suppkey": (3, 7), "l_shipdate": (dt.datetime(1995, 3, 1), dt.datetime(1995, 12, 31))})
