"""Rollup, unpivot, tenant registry, union and distinct."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.functions.cleaning import tenant_key, typed_null
from tierstone.operators.reshape import rollup_segments, unpivot_positive
from tierstone.operators.skew import dealt
from tierstone.plans.layouts import feeder_rows, narrow_projects, segment_rows, wide_projects
from tierstone.plans.registry import Tenant, TenantRegistry


@bound("segment_rollup", """
WITH q AS (SELECT l_orderkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_orderkey, l_quantity AS mode_quantity,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_quantity) AS rn FROM q),
f AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_discount > 0 GROUP BY 1, 2),
g AS (SELECT l_orderkey, l_returnflag AS mode_flag,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_returnflag) AS rn FROM f),
s AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
             max(l_shipdate) AS last_ship, min(l_linestatus) AS any_status, min(l_linenumber) AS first_line
      FROM lineitem GROUP BY 1)
SELECT s.*, mode_quantity, mode_flag
FROM s JOIN m ON s.l_orderkey = m.l_orderkey AND m.rn = 1
LEFT JOIN g ON s.l_orderkey = g.l_orderkey AND g.rn = 1""")
def segment_rollup(spark, sf):
    rolled = rollup_segments(
        table(spark, sf, "lineitem"), ["l_orderkey"],
        mode={
            "mode_quantity": F.col("l_quantity"),
            "mode_flag": F.when(F.col("l_discount") > 0, F.col("l_returnflag")),
        },
        any_value={"any_status": F.col("l_linestatus")},
        total={"total_price": F.col("l_extendedprice").cast("decimal(18,2)")},
        latest={"last_ship": F.col("l_shipdate")},
        earliest={"first_line": F.col("l_linenumber")},
    )
    return rolled.withColumn("total_price", F.col("total_price").cast("double"))


@bound("wide_unpivot", """
WITH u AS (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)
SELECT l_orderkey, measure, amount, 'U1_' || l_orderkey || '_' || measure AS der_id FROM u WHERE amount > 0""")
def wide_unpivot(spark, sf):
    wide = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.col(c).cast("string").alias(c) for c in ("l_quantity", "l_discount", "l_tax")]
    )
    narrow = unpivot_positive(wide, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount")
    der_id = tenant_key(F.lit("U1"), F.col("l_orderkey"), F.col("measure"))
    return narrow.select("l_orderkey", "measure", "amount", der_id.alias("der_id"))


CAPACITIES = {"SolarPV": "l_quantity", "Wind": "l_discount", "Hydro": "l_tax"}


def registry() -> TenantRegistry:
    """Two layouts for three tenants; C shares B's layouts and differs in its date pattern."""
    feeder = feeder_rows("Feeder", {
        "voltage_kv_raw": "kv", "max_hosting_capacity_raw": "max_hc", "hca_refresh_date_raw": "refreshed",
        "color_code_raw": "color", "shape_length_raw": "len",
    })
    segment = segment_rows("Circuit", {
        "voltage_kv_raw": "kv", "max_hosting_capacity_raw": "max_hc", "hca_refresh_date_raw": "refreshed",
        "color_code_raw": "color", "shape_length_raw": "len",
    })
    wide = wide_projects("Project", "Circuit", install_date="InService")
    narrow = narrow_projects("DerId", "Feeder", "DerType", "Rating", install_date="Planned", queue_id="DerId")
    out = TenantRegistry()
    out.register(Tenant("F", segment, wide, wide, "yyyy-MM-dd HH:mm:ssXXX"))
    for name, fmt in (("O", "M/d/yyyy"), ("P", "iso")):
        out.register(Tenant(name, feeder, narrow, narrow, "yyyy/MM/dd HH:mm:ssX", fmt, free_text_types=True))
    return out


def _lines(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return dealt(li, ["l_orderkey"], li.count()).join(o, li.l_orderkey == o.o_orderkey)


def raw_circuits(spark, sf):
    """Order lines of status F as segments of their order, other orders as feeders."""
    lines, o = _lines(spark, sf), table(spark, sf, "orders")
    day = F.col("o_orderdate")
    # whole quantities, so that the sum of lengths is exact in any order
    segments = lines.filter("o_orderstatus = 'F'").select(
        F.col("o_orderstatus").alias("utility_id"),
        F.col("o_orderkey").cast("string").alias("Circuit"),
        F.lit(" 12.5 ").alias("kv"),
        F.col("l_quantity").cast("string").alias("max_hc"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("refreshed"),
        F.lit("0.00 TO 0.29 BROWN-953736").alias("color"),
        F.col("l_quantity").cast("string").alias("len"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.lit(False).alias("_index_col_dropped"),
    )
    feeders = o.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderstatus").alias("utility_id"),
        F.concat_ws("_", F.lit("36"), F.col("o_custkey"), F.col("o_orderkey")).alias("Feeder"),
        F.when(F.col("o_orderpriority") == "5-LOW", "N/A").otherwise("4.0").alias("kv"),
        F.col("o_totalprice").cast("string").alias("max_hc"),
        F.date_format(day, "yyyy/MM/dd HH:mm:ss'+00'").alias("refreshed"),
        F.lit(" Blue ").alias("color"),
    )
    return _stamped(segments.unionByName(feeders, allowMissingColumns=True))


def _stamped(df):
    return df.withColumns({
        "ingestion_timestamp": F.lit("2024-01-30 00:00:00").cast("timestamp"),
        "ingestion_date": F.lit("2024-01-30").cast("date"),
        "pipeline_update_id": F.lit("run_1"),
    })


REGISTRY_CIRCUITS_SQL = """
WITH l AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'),
q AS (SELECT o_orderkey, CAST(l_quantity AS VARCHAR) AS v, count(*) AS n FROM l GROUP BY 1, 2),
m AS (SELECT o_orderkey, v, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, v) AS rn FROM q),
s AS (SELECT o_orderkey, sum(l_quantity) AS len, max(l_shipdate) AS d FROM l GROUP BY 1)
SELECT 'F_' || s.o_orderkey AS feeder_id, 'F' AS utility_id, CAST(s.o_orderkey AS VARCHAR) AS native_feeder_id,
       CAST(12.5 AS DOUBLE) AS voltage_kv, CAST(m.v AS DOUBLE) AS max_hosting_capacity_mw,
       CAST(epoch(d) AS BIGINT) AS refreshed_epoch, '0.00 TO 0.29 BROWN-953736' AS color_code,
       '#953736' AS color_hex, 'BROWN' AS color_name, len AS shape_length,
       CAST(NULL AS INTEGER) AS grid_area_code
FROM s JOIN m ON s.o_orderkey = m.o_orderkey AND rn = 1
UNION ALL
SELECT o_orderstatus || '_36_' || o_custkey || '_' || o_orderkey, o_orderstatus,
       '36_' || o_custkey || '_' || o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN 4.0 END, o_totalprice,
       CAST(epoch(o_orderdate) AS BIGINT), 'Blue', '#0070C0', 'BLUE', NULL, CAST(o_custkey AS INTEGER)
FROM orders WHERE o_orderstatus <> 'F'
"""


@bound("registry_circuits", REGISTRY_CIRCUITS_SQL)
def registry_circuits(spark, sf):
    out = registry().standardize(raw_circuits(spark, sf), "circuits")
    return out.select(
        "feeder_id", "utility_id", "native_feeder_id", "voltage_kv", "max_hosting_capacity_mw",
        F.unix_seconds("hca_refresh_date").alias("refreshed_epoch"), "color_code", "color_hex", "color_name",
        "shape_length", "grid_area_code",
    )


def raw_projects(spark, sf):
    lines = _lines(spark, sf)
    wide = lines.filter("o_orderstatus = 'F'").select(
        F.col("o_orderstatus").alias("utility_id"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("Project"),
        F.when(F.col("l_tax") > 0, F.col("o_custkey").cast("string")).otherwise("NULL").alias("Circuit"),
        *[F.col(c).cast("string").alias(t) for t, c in CAPACITIES.items()],
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("InService"),
    )
    ship = F.when(F.col("o_orderstatus") == "O", F.date_format("l_shipdate", "M/d/yyyy")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    narrow = lines.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderstatus").alias("utility_id"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("DerId"),
        F.col("o_custkey").cast("string").alias("Feeder"),
        F.when(F.col("l_returnflag") == "A", "Solar").when(F.col("l_returnflag") == "N", " storage")
        .otherwise("Tidal").alias("DerType"),
        F.col("l_quantity").cast("string").alias("Rating"),
        ship.alias("Planned"),
    )
    return _stamped(wide.unionByName(narrow, allowMissingColumns=True))


WIDE_SQL = " UNION ALL ".join(
    f"SELECT *, '{t}' AS der_type, {c} AS kw FROM l WHERE o_orderstatus = 'F'" for t, c in CAPACITIES.items()
)
REGISTRY_PROJECTS_SQL = f"""
WITH l AS (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS project
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
w AS ({WIDE_SQL})
SELECT 'F' AS utility_id, 'F_' || project || '_' || der_type AS der_id,
       CASE WHEN l_tax > 0 THEN 'F_' || o_custkey END AS feeder_id, der_type, kw AS nameplate_rating_kw,
       'planned' AS der_status, CAST(l_shipdate AS DATE) AS planned_installation_date,
       CAST(NULL AS VARCHAR) AS interconnection_queue_id
FROM w WHERE kw > 0
UNION ALL
SELECT o_orderstatus, project, o_orderstatus || '_' || o_custkey,
       CASE l_returnflag WHEN 'A' THEN 'SolarPV' WHEN 'N' THEN 'EnergyStorageSystem' ELSE 'Tidal' END,
       l_quantity, 'planned', CAST(l_shipdate AS DATE), project
FROM l WHERE o_orderstatus <> 'F'
"""


@bound("registry_projects", REGISTRY_PROJECTS_SQL)
def registry_projects(spark, sf):
    out = registry().standardize(raw_projects(spark, sf), "der_planned")
    return out.select(
        "utility_id", "der_id", "feeder_id", "der_type", "nameplate_rating_kw", "der_status",
        "planned_installation_date", "interconnection_queue_id",
    )


@bound("union_by_name", """
SELECT o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS priority FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, NULL FROM lineitem""")
def union_by_name(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority")
    )
    li = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("amount"), F.col("l_orderkey").alias("id"))
    return o.unionByName(li, allowMissingColumns=True).withColumn("priority", F.coalesce("priority", typed_null("string")))


@bound("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()
