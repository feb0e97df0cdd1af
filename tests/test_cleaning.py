import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierstone.context import RunContext
from tierstone.functions import colours, parsing
from tierstone.functions.cleaning import (
    drop_raw_tracking_columns,
    normalize_null_sentinels,
    optional_column,
    strip_utf8_bom,
    tenant_key,
)
from tierstone.functions.lineage import add_lineage, file_name, tenant_from_path
from tierstone.functions.rescued import pack_rescued, recover_rescued

RUN = RunContext("run_20240115_103000_abcdef01", dt.datetime(2024, 1, 15, 10, 30))


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize("text", ["NULL", "null", "N/A", "n/a", "NA", "", " NULL ", "  null  ", " N/A ", "  ", "\t", "\n\r\f\x0b"])
def test_null_marker_becomes_null(spark, text):
    assert values(normalize_null_sentinels(spark.createDataFrame([(text,)], "a string")), "a") == [None]


def test_other_text_is_trimmed_and_kept(spark):
    df = spark.createDataFrame([(" value1\t", 1), ("Null", 2), ("123", 3), (None, 4)], "a string, n int")
    assert values(normalize_null_sentinels(df).orderBy("n"), "a") == ["value1", "Null", "123", None]


def test_named_columns_only(spark):
    df = spark.createDataFrame([("NA", "NA")], "a string, b string")
    assert normalize_null_sentinels(df, ["a", "zz"]).first() == (None, "NA")
    assert normalize_null_sentinels(df, []).first() == ("NA", "NA")


def test_blank_policy_keeps_padding(spark):
    df = spark.createDataFrame([(" x ",), (" Null ",), (" ",), ("N/A",)], "a string")
    assert values(normalize_null_sentinels(df, ["a"], policy="blank_or_null"), "a") == [" x ", None, None, "N/A"]


def test_bom_is_stripped_from_names_only(spark):
    df = spark.createDataFrame([("\ufeffv", "w")], ["\ufeffCircuit", "Other"])
    out = strip_utf8_bom(df)
    assert out.columns == ["Circuit", "Other"] and out.first() == ("\ufeffv", "w")
    assert strip_utf8_bom(out) is out


def test_tracking_columns_are_dropped_if_present(spark):
    df = spark.createDataFrame([(1, "x")], "a int, _rescued_data string")
    assert drop_raw_tracking_columns(df).columns == ["a"]


def test_key_with_a_null_part_is_null(spark):
    df = spark.createDataFrame([("t", "a"), ("t", None)], "t string, k string")
    assert values(df.select(tenant_key(F.col("t"), F.col("k")).alias("id")), "id") == ["t_a", None]


def test_optional_column_ignores_case_and_absence(spark):
    df = spark.createDataFrame([("1",)], "Shape_Length string")
    out = df.select(optional_column(df, "shape_length").alias("a"), optional_column(df, "nope").alias("b"))
    assert out.first() == ("1", None) and dict(out.dtypes)["b"] == "string"


@pytest.mark.parametrize("path,tenant", [
    ("/Volumes/dev/bronze/landing/utility_1/circuits/file.csv", "utility_1"),
    ("/data/landing/con_edison/x/file.csv", "con_edison"),
    ("/data/other/file.csv", "unknown"),
])
def test_tenant_from_path(spark, path, tenant):
    row = spark.createDataFrame([(path,)], "p string").select(tenant_from_path(F.col("p")), file_name(F.col("p"))).first()
    assert tuple(row) == (tenant, "file.csv")


def test_lineage_comes_from_the_run(spark):
    df = spark.createDataFrame([("x", 3, None)], "p string, s long, m string")
    out = add_lineage(df, RUN, F.col("p"), F.col("s"), F.col("m"))
    row = out.withColumn("ts", F.unix_seconds("ingestion_timestamp")).first()
    assert row.pipeline_update_id == RUN.run_id and row.ingestion_date == dt.date(2024, 1, 15)
    assert row.ts == int(RUN.run_at.replace(tzinfo=dt.timezone.utc).timestamp())
    assert len(row.file_signature) == 64 and row.utility_id == "unknown"
    assert set(add_lineage(df, RUN).columns) - set(df.columns) == {
        "ingestion_timestamp", "ingestion_date", "pipeline_update_id"
    }


def test_run_id_format():
    run = RunContext.start(dt.datetime(2024, 1, 15, 14, 30, 22))
    assert run.run_id.startswith("run_20240115_143022_") and len(run.run_id) == 28


@pytest.mark.parametrize("given,text,want,flag,rest", [
    (None, {"shape_length": "1.27", "_file_path": "/f"}, "1.27", True, None),
    ("9", {"shape_length": "1.27"}, "9", False, None),
    (None, {"_c0": "123", "_file_path": "/" + "f" * 300}, None, True, None),
    (None, {"new_column": "v", "_file_path": "/f"}, None, False, {"new_column": "v", "_file_path": "/f"}),
    (None, {"a": "1", "shape_length": 2.5, "z": "3"}, "2.5", False, {"a": "1", "z": "3"}),
    (None, None, None, False, None),
    (None, {}, None, False, None),
])
def test_rescued_data(spark, given, text, want, flag, rest):
    raw = None if text is None else json.dumps(text)
    row = recover_rescued(spark.createDataFrame([(given, raw)], "Shape_Length string, _rescued_data string")).first()
    left = row._rescued_data and json.loads(row._rescued_data)
    assert (row.Shape_Length, row._index_col_dropped, left) == (want, flag, rest)


def test_rescued_text_that_is_no_object_is_kept(spark):
    row = recover_rescued(spark.createDataFrame([("{broken",)], "_rescued_data string")).first()
    assert tuple(row) == ("{broken", False)


def test_no_rescued_column(spark):
    assert recover_rescued(spark.createDataFrame([(1,)], "a int")).first() == (1, False)


def test_pack_rescued(spark):
    df = spark.createDataFrame([("1", None), (None, None)], "a string, b string")
    assert values(df.select(pack_rescued({"a": F.col("a"), "b": F.col("b")}).alias("j")), "j") == ['{"a":"1"}', None]


@pytest.mark.parametrize("code,hex_,name", [
    ("0.00 TO 0.29 BROWN-953736", "#953736", "BROWN"),
    ("3.00 TO 4.00 LIGHT BLUE-13afed", "#13afed", "LIGHT BLUE"),
    ("1.00 TO BROWN-953736", "#953736", "BROWN"),
    ("blue", "#0070C0", "BLUE"),
    (" Dark Blue ", "#003366", "DARK BLUE"),
    ("mauve", "#808080", "MAUVE"),
    ("blue-green", "#808080", "BLUE-GREEN"),
    (None, "#808080", None),
])
def test_colours(spark, code, hex_, name):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(colours.color_hex(F.col("c")), colours.color_name(F.col("c"))).first() == (hex_, name)


@pytest.mark.parametrize("text,want", [
    ("Solar", "SolarPV"), (" ENERGY storage ", "EnergyStorageSystem"), ("ICE", "InternalCombustionEngine"),
    ("Tidal", "Tidal"), (None, None),
])
def test_free_text_technology(spark, text, want):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(parsing.canonical_technology(F.col("c"))).first()[0] == want


@pytest.mark.parametrize("native,want", [
    ("36_13_81756", (36, 13, "81756")), ("1501601", (None, None, None)), ("a_b_c", (None, None, "c")),
    ("1_2", (None, None, None)), (None, (None, None, None)),
])
def test_grid_codes(spark, native, want):
    df = spark.createDataFrame([(native,)], "c string")
    assert tuple(df.select(*[c.alias(n) for n, c in parsing.grid_codes(F.col("c")).items()]).first()) == want


def test_dates_by_tenant(spark):
    rows = [
        ("utility1", "2022-06-30 00:00:00+00:00", "2025-06-15"),
        ("utility2", "2022/10/01 00:00:00+00", "6/15/2025"),
        ("utility2", "2022-06-30", "2025-06-15"),
        ("utility3", "2022-06-30 00:00:00+00:00", "2025-06-15"),
        ("utility1", None, None),
    ]
    df = spark.createDataFrame(rows, "t string, ts string, d string")
    t = F.col("t")
    stamp = parsing.timestamp_by_tenant(
        F.col("ts"), t, {"utility1": "yyyy-MM-dd HH:mm:ssXXX", "utility2": "yyyy/MM/dd HH:mm:ssX"}
    )
    day = parsing.date_by_tenant(F.col("d"), t, {"utility1": "iso", "utility2": "M/d/yyyy"})
    got = [tuple(r) for r in df.select(F.unix_seconds(stamp), day).collect()]
    d = dt.date(2025, 6, 15)
    assert got == [(1656547200, d), (1664582400, d), (None, None), (None, None), (None, None)]


def test_parse_failures(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "a string")
    out = parsing.parse_failures(df, {"a": (F.col("a"), parsing.to_double(F.col("a")))})
    assert [tuple(r) for r in out.collect()] == [("a", 2, 1)]
