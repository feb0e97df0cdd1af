"""Cleaning, parsing and lineage functions over text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import bound, table
from tierstone.functions import colours, parsing
from tierstone.functions.cleaning import normalize_null_sentinels, strip_utf8_bom, tenant_key
from tierstone.functions.lineage import file_name, file_signature, tenant_from_path
from tierstone.functions.rescued import pack_rescued, recover_rescued
from tierstone.operators import quality
from tierstone.vocab import COLOUR_HEX, TECHNOLOGIES, TECHNOLOGY_SYNONYMS

DIRTY = "CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN ' NULL ' WHEN 1 THEN 'n/a' WHEN 2 THEN '  ' " \
        "WHEN 3 THEN concat({tab}, 'NA', {tab}) WHEN 4 THEN 'Null' WHEN 5 THEN concat('  ', c_name, {tab}) " \
        "WHEN 6 THEN CAST(NULL AS {text}) ELSE c_name END"
SPARK_DIRTY = DIRTY.format(tab="'\\t'", text="STRING")
SQL_DIRTY = DIRTY.format(tab="chr(9)", text="VARCHAR")


def dirty_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.expr(SPARK_DIRTY).alias("note"), F.col("c_mktsegment").alias("utility_id")
    )


@bound("null_sentinels", f"""
WITH d AS (SELECT c_custkey, c_mktsegment AS utility_id, {SQL_DIRTY} AS note FROM customer),
t AS (SELECT c_custkey, utility_id, regexp_replace(note, '^\\s+|\\s+$', '', 'g') AS note FROM d)
SELECT c_custkey, utility_id,
       CASE WHEN note IN ('NULL', 'null', 'N/A', 'n/a', 'NA', '') THEN NULL ELSE note END AS note
FROM t""")
def null_sentinels(spark, sf):
    return normalize_null_sentinels(dirty_customers(spark, sf))


@bound("null_sentinels_blank", f"""
WITH d AS (SELECT c_custkey, c_mktsegment AS utility_id, {SQL_DIRTY} AS note FROM customer)
SELECT c_custkey, utility_id,
       CASE WHEN note IS NULL OR trim(note) = '' OR upper(trim(note)) = 'NULL' THEN NULL ELSE note END AS note
FROM d""")
def null_sentinels_blank(spark, sf):
    return normalize_null_sentinels(dirty_customers(spark, sf), ["note", "absent"], policy="blank_or_null")


@bound("residual_sentinels", f"""
WITH d AS (SELECT c_mktsegment AS utility_id, {SQL_DIRTY} AS note,
                  CASE WHEN c_acctbal < 0 THEN ' null' ELSE c_name END AS label FROM customer)
SELECT column_name, sentinel_value, utility_id, count(*) AS count FROM (
  SELECT 'note' AS column_name, note AS sentinel_value, utility_id FROM d
  UNION ALL SELECT 'label', label, utility_id FROM d)
WHERE trim(sentinel_value) = '' OR upper(trim(sentinel_value)) = 'NULL'
GROUP BY 1, 2, 3""")
def residual_sentinels(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("utility_id"),
        F.expr(SPARK_DIRTY).alias("note"),
        F.when(F.col("c_acctbal") < 0, " null").otherwise(F.col("c_name")).alias("label"),
    )
    return quality.residual_sentinels(rows, ["note", "label", "absent"])


@bound("rescued_columns", """
WITH e AS (
  SELECT event_id, CASE WHEN value < 5 THEN event_type END AS shape_given, props, value,
         json_extract_string(props, '$.k') AS k,
         CASE event_type WHEN 'view' THEN 'variant' WHEN 'click' THEN 'artifact' WHEN 'error' THEN 'drift'
              WHEN 'signup' THEN 'mixed' ELSE 'none' END AS kind
  FROM events)
SELECT event_id,
       CASE WHEN kind IN ('variant', 'mixed') THEN coalesce(shape_given, k) ELSE shape_given END AS "Shape_Length",
       kind IN ('variant', 'artifact') AS _index_col_dropped,
       CASE WHEN kind IN ('drift', 'mixed') THEN k END AS drift_value,
       kind IN ('drift', 'mixed') AS has_rescued
FROM e""")
def rescued_columns(spark, sf):
    """Rescued objects of four kinds around the event's own JSON value."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    values = {
        "shape_length": F.when(kind.isin("view", "signup"), k),
        "_c0": F.when(kind == "click", F.col("event_id").cast("string")),
        "new_column": F.when(kind.isin("error", "signup"), k),
        "_file_path": F.when(kind != "purchase", F.concat(F.lit("/landing/t/"), F.col("user_id"))),
    }
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("value") < 5, kind).alias("Shape_Length"),
        pack_rescued(values).alias("_rescued_data"),
    )
    out = recover_rescued(rows)
    rest = F.from_json("_rescued_data", "map<string,string>")
    return out.select(
        "event_id", "Shape_Length", "_index_col_dropped",
        F.try_element_at(rest, F.lit("new_column")).alias("drift_value"),
        F.col("_rescued_data").isNotNull().alias("has_rescued"),
    )


@bound("file_lineage", """
WITH f AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN '/archive/' || o_orderpriority || '/' || o_orderkey || '.csv'
              ELSE '/vol/landing/' || o_orderpriority || '/circuits/' || o_orderkey || '.csv' END AS path,
         CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_custkey END AS size,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS modified
  FROM orders)
SELECT o_orderkey, CASE WHEN path LIKE '%/landing/%' THEN split_part(path, '/', 4) ELSE 'unknown' END AS utility_id,
       CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
       sha256(path || coalesce(CAST(size AS VARCHAR), '0') || coalesce(modified, '')) AS file_signature
FROM f""")
def file_lineage(spark, sf):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    path = F.when(
        status == "P", F.concat(F.lit("/archive/"), F.col("o_orderpriority"), F.lit("/"), key, F.lit(".csv"))
    ).otherwise(F.concat(F.lit("/vol/landing/"), F.col("o_orderpriority"), F.lit("/circuits/"), key, F.lit(".csv")))
    size = F.when(F.col("o_totalprice") >= 100000, F.col("o_custkey"))
    modified = F.when(status != "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        tenant_from_path(path).alias("utility_id"),
        file_name(path).alias("file_name"),
        file_signature(path, size, modified).alias("file_signature"),
    )


def _order_texts(spark, sf):
    o = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    return o.select(
        "o_orderkey",
        status.alias("utility_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n.n.").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss'+00:00'"))
        .when(status == "O", F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss'+00'"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("refreshed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "soon")
        .when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("installed"),
    )


REFRESH_FORMATS = {"F": "yyyy-MM-dd HH:mm:ssXXX", "O": "yyyy/MM/dd HH:mm:ssX"}
INSTALL_FORMATS = {"F": "iso", "O": "M/d/yyyy", "P": "M/d/yyyy"}


@bound("typed_parse", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS amount,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(epoch(o_orderdate) AS BIGINT) END AS refreshed_epoch,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS installed_on
FROM orders""")
def typed_parse(spark, sf):
    tenant = F.col("utility_id")
    refreshed = parsing.timestamp_by_tenant(F.col("refreshed"), tenant, REFRESH_FORMATS)
    return _order_texts(spark, sf).select(
        "o_orderkey",
        parsing.to_double(F.col("amount")).alias("amount"),
        F.unix_seconds(refreshed).alias("refreshed_epoch"),
        parsing.date_by_tenant(F.col("installed"), tenant, INSTALL_FORMATS).alias("installed_on"),
    )


@bound("parse_failures", """
SELECT 'amount' AS column_name, count(*) AS attempted,
       count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS failed FROM orders
UNION ALL SELECT 'refreshed', count(*), count(CASE WHEN o_orderstatus = 'P' THEN 1 END) FROM orders
UNION ALL SELECT 'installed', count(*), count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) FROM orders""")
def parse_failures(spark, sf):
    tenant, c = F.col("utility_id"), F.col
    return parsing.parse_failures(_order_texts(spark, sf), {
        "amount": (c("amount"), parsing.to_double(c("amount"))),
        "refreshed": (c("refreshed"), parsing.timestamp_by_tenant(c("refreshed"), tenant, REFRESH_FORMATS)),
        "installed": (c("installed"), parsing.date_by_tenant(c("installed"), tenant, INSTALL_FORMATS)),
    })


COLOUR_TEXT = """CASE p_type WHEN 'ECONOMY' THEN concat('0.00 TO 0.29 ', split_part(p_name, ' ', 1), '-95373', p_size % 10)
  WHEN 'LARGE' THEN concat(' ', split_part(p_name, ' ', 1), ' ')
  WHEN 'MEDIUM' THEN concat('1.00 TO ', split_part(p_name, ' ', 1), '-0070c0')
  WHEN 'PROMO' THEN 'blue-green' WHEN 'SMALL' THEN 'Light Blue' ELSE CAST(NULL AS {text}) END"""
COLOUR_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLOUR_HEX.items())


@bound("colour_codes", f"""
WITH c AS (SELECT p_partkey, {COLOUR_TEXT.format(text="VARCHAR")} AS code FROM part)
SELECT p_partkey, code AS color_code,
       CASE WHEN regexp_matches(code, '-[0-9A-Fa-f]{{6}}$') THEN '#' || right(code, 6)
            ELSE coalesce(CASE lower(trim(code)) {COLOUR_CASE} END, '#808080') END AS color_hex,
       CASE WHEN regexp_matches(code, '[A-Za-z][A-Za-z\\s]*-[0-9A-Fa-f]{{6}}$')
            THEN regexp_replace(upper(trim(regexp_extract(code, '([A-Za-z][A-Za-z\\s]*)-[0-9A-Fa-f]{{6}}$', 1))),
                                '^TO\\s+', '')
            ELSE upper(trim(code)) END AS color_name
FROM c""")
def colour_codes(spark, sf):
    code = F.expr(COLOUR_TEXT.format(text="STRING"))
    return table(spark, sf, "part").select("p_partkey", code.alias("color_code")).withColumns({
        "color_hex": colours.color_hex(F.col("color_code")),
        "color_name": colours.color_name(F.col("color_code")),
    })


TYPE_TEXT = """CASE p_type WHEN 'ECONOMY' THEN ' Solar PV' WHEN 'LARGE' THEN 'BATTERY' WHEN 'MEDIUM' THEN 'Tidal'
  WHEN 'PROMO' THEN 'chp ' WHEN 'SMALL' THEN p_name ELSE CAST(NULL AS {text}) END"""
SYNONYM_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TECHNOLOGY_SYNONYMS.items())
VOCABULARY = ", ".join(f"'{t}'" for t in TECHNOLOGIES)
DER_SQL = f"""
WITH t AS (SELECT p_partkey, p_brand AS utility_id, p_size, {TYPE_TEXT.format(text="VARCHAR")} AS free FROM part),
d AS (SELECT utility_id, CAST(p_partkey AS VARCHAR) AS der_id,
             coalesce(CASE lower(trim(free)) {SYNONYM_CASE} END, free) AS der_type,
             CAST(p_size AS DOUBLE) AS nameplate_rating_kw, DATE '2024-01-01' + p_size AS ingestion_date FROM t)
"""


def _typed_parts(spark, sf):
    free = F.expr(TYPE_TEXT.format(text="STRING"))
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("utility_id"),
        F.col("p_partkey").cast("string").alias("der_id"),
        parsing.canonical_technology(free).alias("der_type"),
        F.col("p_size").cast("double").alias("nameplate_rating_kw"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("ingestion_date"),
    )


@bound("canonical_types", DER_SQL + "SELECT * FROM d")
def canonical_types(spark, sf):
    return _typed_parts(spark, sf)


@bound("invalid_types", DER_SQL + f"SELECT * FROM d WHERE der_type NOT IN ({VOCABULARY})")
def invalid_types(spark, sf):
    return quality.invalid_types(_typed_parts(spark, sf))


@bound("unmapped_types", DER_SQL + f"""
SELECT utility_id, der_type, count(*) AS unmapped_count, sum(nameplate_rating_kw) AS unmapped_capacity_kw,
       min(ingestion_date) AS first_seen, max(ingestion_date) AS last_seen,
       '⚠️ Unmapped der_type ''' || der_type || ''' found in ' || utility_id || ' data (' || count(*) || ' projects, '
         || round(sum(nameplate_rating_kw), 2) || ' kW). Extend the technology synonyms.' AS alert_message
FROM d WHERE utility_id IN ('Brand#1', 'Brand#2', 'Brand#3') AND der_type NOT IN ({VOCABULARY})
GROUP BY 1, 2""")
def unmapped_types(spark, sf):
    return quality.unmapped_types(_typed_parts(spark, sf), ["Brand#1", "Brand#2", "Brand#3"])


GRID_TEXT = """CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS {text}) WHEN c_acctbal > 9000 THEN concat('x_', n_nationkey, '_', c_custkey)
  ELSE concat(n_regionkey, '_', n_nationkey, '_', c_custkey) END"""


@bound("grid_codes", f"""
WITH g AS (SELECT c_custkey, {GRID_TEXT.format(text="VARCHAR")} AS id
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey,
       CASE WHEN len(string_split(id, '_')) = 3 THEN TRY_CAST(split_part(id, '_', 1) AS INTEGER) END AS grid_state_code,
       CASE WHEN len(string_split(id, '_')) = 3 THEN TRY_CAST(split_part(id, '_', 2) AS INTEGER) END AS grid_area_code,
       CASE WHEN len(string_split(id, '_')) = 3 THEN split_part(id, '_', 3) END AS grid_circuit_id
FROM g""")
def grid_codes(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    native = F.expr(GRID_TEXT.format(text="STRING"))
    return rows.select("c_custkey", *[c.alias(n) for n, c in parsing.grid_codes(native).items()])


@bound("tenant_keys", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax > 0 THEN l_returnflag || '_' || l_orderkey || '_' || l_linestatus END AS der_id
FROM lineitem""")
def tenant_keys(spark, sf):
    key = tenant_key(F.col("l_returnflag"), F.when(F.col("l_tax") > 0, F.col("l_orderkey")), F.col("l_linestatus"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.alias("der_id"))


@bound("bom_columns", "SELECT s_suppkey, s_name FROM supplier")
def bom_columns(spark, sf):
    marked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("\ufeffs_suppkey"), "s_name")
    return strip_utf8_bom(marked)
