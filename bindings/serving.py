"""Serving tables over customers (feeders) and orders (projects).

Tenant = market segment, installed = orders with status F, planned = the other orders, technology
= part type.  Orders of priority 5-LOW are closed versions, so that current-state filtering has
something to filter.  Money is summed as decimal, because a floating-point sum
depends on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.operators import serving
from tierstone.operators.skew import dealt

PART_TYPES = ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "SMALL", "LARGE")


def circuits(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as feeders; those with a balance below -900 are closed versions."""
    c = table(spark, sf, "customer")
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    return c.select(
        F.col("c_custkey").alias("feeder_id"),
        F.col("c_mktsegment").alias("utility_id"),
        F.col("c_name").alias("native_feeder_id"),
        F.col("c_nationkey").cast("double").alias("voltage_kv"),
        balance.alias("max_hosting_capacity_mw"),
        (balance / 2).cast("decimal(18,3)").alias("min_hosting_capacity_mw"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")).alias("grid_area_code"),
        (F.col("c_nationkey") % 5).alias("grid_state_code"),
        F.col("c_custkey").cast("string").alias("grid_circuit_id"),
        F.when(F.col("c_acctbal") > 8000, F.concat(F.lit("POINT "), F.col("c_custkey"))).alias("geom_wkt"),
        F.lower("c_mktsegment").alias("color_code"),
        F.lit("#808080").alias("color_hex"),
        F.col("c_mktsegment").alias("color_name"),
        F.length("c_name").cast("double").alias("shape_length"),
        F.lit("2024-01-30").cast("date").alias("hca_refresh_date"),
        F.when(F.col("c_acctbal") < -900, F.lit("2024-01-15").cast("date")).alias("__END_AT"),
    )


# above so many rows a dimension is not broadcast, and the lines that meet it are dealt over tasks
LARGE_DIMENSION = 2_000_000


def all_projects(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as projects of their customer, one row per order line with the part's type, told apart by status.

    Orders of priority 5-LOW are closed versions; lines with tax 0 have no feeder. Lines meet their orders last,
    dealt over tasks by their number; orders are as narrow as the result needs by then.
    """
    o, li, p, c = (table(spark, sf, t) for t in ("orders", "lineitem", "part", "customer"))
    n_lines = li.count()
    if p.count() > LARGE_DIMENSION:
        li = dealt(li, ["l_partkey"], n_lines)
    if c.count() > LARGE_DIMENSION:
        o = dealt(o, ["o_custkey"], o.count())
    orders = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        "o_custkey",
        "c_mktsegment",
        F.when(F.col("o_orderstatus") == "F", "installed").otherwise("planned").alias("installation_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate")).alias("__END_AT"),
    )
    lines = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_tax", "l_quantity", "p_type")
    lines = dealt(lines, ["l_orderkey"], n_lines)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(F.col("l_tax") > 0, F.col("o_custkey")).alias("feeder_id"),
        F.col("c_mktsegment").alias("utility_id"),
        F.concat_ws("_", F.col("o_orderkey"), F.col("p_type")).alias("der_id"),
        F.col("p_type").alias("der_type"),
        F.col("l_quantity").cast("decimal(18,2)").alias("nameplate_rating_kw"),
        "__END_AT",
        "installation_status",
    )


def projects(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The same as installed and planned rows."""
    rows = all_projects(spark, sf)
    return tuple(rows.filter(F.col("installation_status") == s).drop("installation_status") for s in ("installed", "planned"))


def orders_as_projects(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = o.join(c, "o_custkey").select(
        F.col("o_custkey").alias("feeder_id"),
        F.col("c_mktsegment").alias("utility_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("nameplate_rating_kw"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate")).alias("__END_AT"),
        "o_orderstatus",
    )
    return rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus <> 'F'")


def to_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles with 3 digits, for a comparison that ignores decimal scale."""
    return df.select(*[
        F.round(F.col(c), 3).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes
    ])


CIRCUITS_SQL = """
circuits AS (
  SELECT c_custkey AS feeder_id, c_mktsegment AS utility_id, c_name AS native_feeder_id,
         CAST(c_nationkey AS DOUBLE) AS voltage_kv,
         CAST(c_acctbal AS DECIMAL(18,2)) AS max_mw,
         CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS grid_area_code,
         c_nationkey % 5 AS grid_state_code, CAST(c_custkey AS VARCHAR) AS grid_circuit_id,
         CASE WHEN c_acctbal > 8000 THEN 'POINT ' || c_custkey END AS geom_wkt,
         lower(c_mktsegment) AS color_code, CAST(length(c_name) AS DOUBLE) AS shape_length
  FROM customer WHERE NOT c_acctbal < -900)
"""
ORDER_LOAD_SQL = """
load AS (
  SELECT o_custkey AS feeder_id, c_mktsegment AS utility_id,
         count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS i_n,
         coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS i_kw,
         count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS p_n,
         coalesce(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS p_kw
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2)
"""
FEEDERS_SQL = f"""
WITH {CIRCUITS_SQL}, {ORDER_LOAD_SQL},
feeders AS (
  SELECT c.feeder_id, c.utility_id, native_feeder_id, voltage_kv,
         CAST(max_mw AS DOUBLE) AS max_hosting_capacity_mw,
         round(CAST(max_mw AS DOUBLE) / 2, 3) AS min_hosting_capacity_mw,
         coalesce(i_n, 0) AS installed_der_count, CAST(coalesce(i_kw, 0) AS DOUBLE) AS installed_capacity_kw,
         coalesce(p_n, 0) AS planned_der_count, CAST(coalesce(p_kw, 0) AS DOUBLE) AS planned_capacity_kw,
         coalesce(i_n, 0) + coalesce(p_n, 0) AS total_der_count,
         CAST(coalesce(i_kw, 0) + coalesce(p_kw, 0) AS DOUBLE) AS total_der_capacity_kw,
         CAST(round(max_mw - CAST(coalesce(i_kw, 0) + coalesce(p_kw, 0) AS DECIMAL(24,2)) * 0.001, 3) AS DOUBLE)
           AS available_capacity_mw,
         color_code, '#808080' AS color_hex, c.utility_id AS color_name, shape_length,
         DATE '2024-01-30' AS capacity_as_of_date
  FROM circuits c LEFT JOIN load l ON c.feeder_id = l.feeder_id AND c.utility_id = l.utility_id)
"""


def feeders(spark: SparkSession, sf: str) -> DataFrame:
    return to_doubles(serving.feeders_with_capacity(circuits(spark, sf), *orders_as_projects(spark, sf)))


@bound("feeders_with_capacity", FEEDERS_SQL + "SELECT * FROM feeders")
def feeders_with_capacity(spark, sf):
    return feeders(spark, sf)


@bound("feeders_min_capacity", FEEDERS_SQL + """
SELECT feeder_id, utility_id, available_capacity_mw FROM feeders
WHERE available_capacity_mw >= 5 AND utility_id = 'BUILDING'""")
def feeders_min_capacity(spark, sf):
    hit = serving.with_min_capacity(feeders(spark, sf), 5.0, "BUILDING")
    return hit.select("feeder_id", "utility_id", "available_capacity_mw")


@bound("feeders_available", FEEDERS_SQL + """
SELECT utility_id, count(*) AS feeder_count FROM feeders WHERE available_capacity_mw > 0 GROUP BY 1""")
def feeders_available(spark, sf):
    hit = serving.with_available_capacity(feeders(spark, sf))
    return hit.groupBy("utility_id").agg(F.count("*").alias("feeder_count"))


@bound("feeder_capacity_rank", FEEDERS_SQL + """
SELECT feeder_id, utility_id, available_capacity_mw,
       rank() OVER (PARTITION BY utility_id ORDER BY available_capacity_mw DESC NULLS LAST) AS capacity_rank
FROM feeders""")
def feeder_capacity_rank(spark, sf):
    ranked = serving.rank_by_capacity(feeders(spark, sf))
    return ranked.select("feeder_id", "utility_id", "available_capacity_mw", "capacity_rank")


@bound("feeder_capacity_top10", FEEDERS_SQL + """
SELECT * FROM (
  SELECT feeder_id, utility_id, available_capacity_mw,
         rank() OVER (PARTITION BY utility_id ORDER BY available_capacity_mw DESC NULLS LAST) AS capacity_rank
  FROM feeders)
WHERE capacity_rank <= 10""")
def feeder_capacity_top10(spark, sf):
    top = serving.top_by_capacity(feeders(spark, sf), 10)
    return top.select("feeder_id", "utility_id", "available_capacity_mw", "capacity_rank")


DER_SQL = """
der AS (
  SELECT CASE WHEN l_tax > 0 THEN o_custkey END AS feeder_id, c_mktsegment AS utility_id,
         o_orderkey || '_' || p_type AS der_id, p_type AS der_type, CAST(l_quantity AS DECIMAL(18,2)) AS kw,
         CASE WHEN o_orderstatus = 'F' THEN 'installed' ELSE 'planned' END AS status
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority <> '5-LOW')
"""
PIVOT_SQL = ", ".join(
    f"count(CASE WHEN der_type = '{t}' THEN 1 END) AS {t.lower()}_count, "
    f"CAST(coalesce(sum(CASE WHEN der_type = '{t}' THEN kw END), 0) AS DOUBLE) AS {t.lower()}_capacity_kw"
    for t in PART_TYPES
)
SUMMARY_SQL = f"""
WITH {DER_SQL},
summary AS (
  SELECT feeder_id, utility_id, count(*) AS total_der_count, count(DISTINCT der_id) AS unique_project_count,
         count(CASE WHEN status = 'installed' THEN 1 END) AS installed_count,
         CAST(coalesce(sum(CASE WHEN status = 'installed' THEN kw END), 0) AS DOUBLE) AS installed_capacity_kw,
         count(CASE WHEN status = 'planned' THEN 1 END) AS planned_count,
         CAST(coalesce(sum(CASE WHEN status = 'planned' THEN kw END), 0) AS DOUBLE) AS planned_capacity_kw,
         {PIVOT_SQL},
         count(DISTINCT der_type) AS technology_type_count,
         count(DISTINCT der_type) > 1 AS has_hybrid_projects
  FROM der WHERE feeder_id IS NOT NULL GROUP BY 1, 2)
"""


@bound("feeder_der_summary", SUMMARY_SQL + "SELECT * FROM summary")
def feeder_der_summary(spark, sf):
    return to_doubles(serving.feeder_der_summary(all_projects(spark, sf), technologies=PART_TYPES))


MAP_SQL = SUMMARY_SQL + f"""
, {CIRCUITS_SQL},
layer AS (
  SELECT c.feeder_id, c.utility_id, native_feeder_id, grid_state_code, grid_area_code, grid_circuit_id,
         color_code, '#808080' AS color_hex, c.utility_id AS color_name,
         CAST(max_mw AS DOUBLE) AS max_hosting_capacity_mw,
         round(CAST(max_mw AS DOUBLE) / 2, 3) AS min_hosting_capacity_mw,
         round(CAST(max_mw AS DOUBLE) - coalesce(installed_capacity_kw, 0) / 1000
               - coalesce(planned_capacity_kw, 0) / 1000, 3) AS available_capacity_mw,
         coalesce(installed_count, 0) AS installed_der_count, coalesce(planned_count, 0) AS planned_der_count,
         coalesce(installed_capacity_kw, 0) AS total_installed_capacity_kw,
         coalesce(planned_capacity_kw, 0) AS total_planned_capacity_kw,
         geom_wkt,
         CASE WHEN geom_wkt IS NOT NULL THEN 'geometry' WHEN grid_area_code IS NOT NULL THEN 'district'
              ELSE 'point_fallback' END AS map_render_level,
         DATE '2024-01-30' AS capacity_as_of_date, DATE '2024-01-30' AS data_as_of_date
  FROM circuits c LEFT JOIN summary s ON c.feeder_id = s.feeder_id AND c.utility_id = s.utility_id)
"""


def map_layer(spark: SparkSession, sf: str) -> DataFrame:
    summary = serving.feeder_der_summary(all_projects(spark, sf), technologies=PART_TYPES)
    layer = serving.feeder_map_layer(circuits(spark, sf), summary)
    mw = F.round(F.col("available_capacity_mw").cast("double"), 3)
    return to_doubles(layer.withColumn("available_capacity_mw", mw))


@bound("feeder_map_layer", MAP_SQL + "SELECT * FROM layer")
def feeder_map_layer(spark, sf):
    return map_layer(spark, sf)


@bound("map_slice", MAP_SQL + """
SELECT feeder_id, grid_area_code, map_render_level FROM layer
WHERE utility_id = 'MACHINERY' AND grid_area_code IN (2, 4, 10)""")
def map_slice(spark, sf):
    hit = serving.map_slice(map_layer(spark, sf), "MACHINERY", [2, 4, 10])
    return hit.select("feeder_id", "grid_area_code", "map_render_level")


@bound("der_of_feeder", f"""
WITH {DER_SQL}
SELECT feeder_id, utility_id, der_id, der_type, CAST(kw AS DOUBLE) AS nameplate_rating_kw,
       status AS installation_status
FROM der WHERE feeder_id = 7""")
def der_of_feeder(spark, sf):
    return to_doubles(serving.der_of_feeder(*projects(spark, sf), feeder_id=7))


@bound("technology_distribution", f"""
WITH {DER_SQL}
SELECT der_type, status AS installation_status, count(*) AS der_count, CAST(sum(kw) AS DOUBLE) AS capacity_kw
FROM der GROUP BY 1, 2""")
def technology_distribution(spark, sf):
    return to_doubles(serving.technology_distribution(all_projects(spark, sf)))


@bound("hybrid_projects", """
SELECT c_mktsegment AS utility_id, CAST(o_orderkey AS VARCHAR) AS project_id,
       count(DISTINCT p_type) AS technology_count
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2 HAVING count(DISTINCT p_type) > 1""")
def hybrid_projects(spark, sf):
    return serving.hybrid_projects(all_projects(spark, sf), table(spark, sf, "lineitem").count())


@bound("project_counts", """
SELECT o_custkey AS feeder_id, c_mktsegment AS utility_id, count(*) AS der_rows,
       count(DISTINCT o_orderkey) AS project_count
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
WHERE l_tax > 0 GROUP BY 1, 2""")
def project_counts(spark, sf):
    return serving.project_counts(all_projects(spark, sf))


@bound("orphan_orders", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def orphan_orders(spark, sf):
    parents = table(spark, sf, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return serving.orphans(table(spark, sf, "orders"), parents, ["o_custkey"]).select("o_orderkey", "o_custkey")


@bound("unresolved_projects", """
SELECT c_mktsegment AS utility_id, count(*) AS unresolved
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
WHERE NOT l_tax > 0 GROUP BY 1""")
def unresolved_projects(spark, sf):
    rows = serving.unresolved(all_projects(spark, sf), ["feeder_id"])
    return rows.groupBy("utility_id").agg(F.count("*").alias("unresolved"))
