import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierstone.operators import observe, quality

DAY = dt.date(2024, 1, 1)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture()
def readings(spark):
    return spark.createDataFrame(
        [("f1", "10.5"), ("f2", "not_a_number"), (None, "8.0"), ("f3", None)], "feeder_id string, capacity string"
    )


RULES = {"has_feeder": "feeder_id IS NOT NULL", "number": "try_cast(capacity AS double) > 1"}


def test_warn_keeps_all_and_null_fails(readings):
    got = {r.feeder_id: r._failed_rules for r in quality.tag_failures(readings, RULES).collect()}
    assert got == {"f1": [], "f2": ["number"], None: ["has_feeder"], "f3": ["number"]}


def test_drop(readings):
    assert [r.feeder_id for r in quality.expect_or_drop(readings, RULES).collect()] == ["f1"]


def test_violations(readings):
    assert rows_of(quality.violations(readings, RULES)) == [("has_feeder", 4, 1), ("number", 4, 2)]


def test_quarantine_splits_what_was_written_once(spark, readings, tmp_path):
    quality.write_with_quarantine(readings, RULES, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    good, bad = quality.read_passed(stored), quality.read_quarantined(stored)
    assert good.columns == ["feeder_id", "capacity"] and [r.feeder_id for r in good.collect()] == ["f1"]
    assert bad.count() == 3 and "_failed_rules" in bad.columns
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_in_memory_split(readings):
    tagged = quality.tag_failures(readings, RULES)
    assert (quality.passed(tagged).count(), quality.quarantined(tagged).count()) == (1, 3)


def test_quality_metrics(spark):
    df = spark.createDataFrame([
        ("u", DAY, "r", "a", -1.0, "f", dt.datetime(2023, 12, 1)), ("u", DAY, "r", None, 2.0, "", dt.datetime(2023, 11, 1)),
        ("u", DAY, "r", "b", None, None, None),
    ], "utility_id string, ingestion_date date, pipeline_update_id string, der_id string, kw double, feeder_id string, at timestamp")
    row = quality.quality_metrics(df, "t", "der_id", "kw", "feeder_id", "at", F.lit(DAY)).first()
    assert tuple(row)[3:] == (3, 1, 1, 2, dt.date(2023, 12, 1), 31, "t")
    row = quality.quality_metrics(df, "t", "der_id", "kw").first()
    assert tuple(row)[3:] == (3, 1, 1, 0, None, None, "t")


def test_unmapped_and_invalid_types(spark):
    df = spark.createDataFrame([
        ("u2", "1", "Tidal", 5.125, DAY), ("u2", "2", "Tidal", 5.0, DAY + dt.timedelta(days=3)), ("u2", "3", "SolarPV", 1.0, DAY),
        ("u1", "4", "Tidal", 1.0, DAY), ("u2", "5", None, 1.0, DAY),
    ], "utility_id string, der_id string, der_type string, nameplate_rating_kw double, ingestion_date date")
    row = quality.unmapped_types(df, ["u2"]).first()
    assert tuple(row)[:6] == ("u2", "Tidal", 2, 10.125, DAY, DAY + dt.timedelta(days=3))
    assert "'Tidal' found in u2 data (2 projects, 10.13 kW)" in row.alert_message
    assert {r.der_id for r in quality.invalid_types(df).collect()} == {"1", "2", "4"}


def test_residual_sentinels(spark):
    df = spark.createDataFrame([("t", "NULL", " "), ("t", "x", "Null"), ("t", None, "N/A")], "utility_id string, a string, b string")
    got = {tuple(r) for r in quality.residual_sentinels(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "NULL", "t", 1), ("b", " ", "t", 1), ("b", "Null", "t", 1)}
    empty = quality.residual_sentinels(df, ["zz"])
    assert empty.count() == 0 and empty.columns == ["column_name", "sentinel_value", "utility_id", "count"]


def test_key_uniqueness_and_unregistered(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "utility_id string, k int")
    assert rows_of(quality.key_uniqueness(df, ["utility_id", "k"])) == [(4, 3, 1)]
    assert rows_of(quality.key_uniqueness(df.limit(0), ["k"])) == [(0, 0, 0)]
    assert set(rows_of(quality.unregistered_tenants(df, ["a"]))) == {("b", 1), (None, 1)}


def metrics_frame(spark, counts, extra=()):
    rows = [("u", "der_installed", DAY + dt.timedelta(days=i), f"r{i:03}", n) for i, n in enumerate(counts)]
    return spark.createDataFrame(
        [*rows, *extra], "utility_id string, table_name string, ingestion_date date, pipeline_update_id string, total_records long"
    )


def judged(spark, counts, **kw):
    out = observe.volume_baseline(metrics_frame(spark, counts), **kw).orderBy("pipeline_update_id")
    return out.collect()


def test_baseline_statuses(spark):
    got = judged(spark, [100, 102, 98, 100, 10, 100, 500])
    assert [r.status for r in got] == [*["INSUFFICIENT_BASELINE"] * 3, "NORMAL", "ANOMALY_LOW", "NORMAL", "ANOMALY_HIGH"]
    assert got[0].baseline_run_count == 0 and got[0].baseline_avg is None and got[1].z_score is None
    low = got[4]
    assert (low.baseline_avg, low.lower_bound_2sigma) == (100.0, 97.0)
    assert low.explanation == "⚠️  Record count below expected range (90.0% below baseline)"
    assert got[3].explanation == "✅ Within normal range"


def test_constant_series_makes_any_change_an_anomaly_without_z(spark):
    got = judged(spark, [5, 5, 5, 5, 6])
    assert (got[3].status, got[4].status, got[4].z_score) == ("NORMAL", "ANOMALY_HIGH", None)


def test_only_30_rows_count_and_today_filter(spark):
    counts = [1000] * 5 + [10, 12] * 16
    last = DAY + dt.timedelta(days=len(counts) - 1)
    (row,) = judged(spark, counts, as_of=last)
    assert (row.ingestion_date, row.baseline_run_count, row.baseline_avg) == (last, 30, 11.0)


def test_two_runs_on_one_day_are_ordered_by_run(spark):
    extra = [("u", "der_installed", DAY, "r000b", 7)]
    df = metrics_frame(spark, [5, 6], extra)
    out = observe.volume_baseline(df).orderBy("pipeline_update_id").collect()
    assert [(r.pipeline_update_id, r.baseline_run_count) for r in out] == [("r000", 0), ("r000b", 1), ("r001", 2)]
    by_day = observe.volume_baseline(df, days=30).orderBy("pipeline_update_id").collect()
    assert [r.baseline_run_count for r in by_day] == [0, 0, 2]


def test_alert_rollup(spark):
    df = observe.volume_baseline(metrics_frame(spark, [100, 102, 98, 100, 10]))
    assert rows_of(observe.alert_rollup(df)) == [(1, "u.der_installed")]
    assert rows_of(observe.alert_rollup(df.filter("false"))) == [(0, "")]


def test_severity_ladder(spark):
    rows = [("c", 1, 0, 0, None), ("s", 0, 0, 46, None), ("h", 0, 0, 31, None), ("l", 0, 0, 0, "ANOMALY_LOW"),
            ("a", 0, 0, 0, "ANOMALY_HIGH"), ("m", 0, 1001, None, "NORMAL"), ("w", 0, 501, None, None), ("o", 0, 500, 30, "NORMAL")]
    df = spark.createDataFrame(
        [("t", name, DAY, "r", 10, nk, un, age) for name, nk, un, age, _ in rows],
        "utility_id string, table_name string, ingestion_date date, pipeline_update_id string, total_records long, "
        "null_key_count long, unresolved_feeder_count long, days_since_refresh int")
    status = spark.createDataFrame([("t", n, DAY, "r", s) for n, *_, s in rows if s],
                                   "utility_id string, table_name string, ingestion_date date, pipeline_update_id string, status string")
    out = observe.alert_severity(df, status)
    assert {r.table_name: r.severity for r in out.collect()} == dict(
        c="CRITICAL", s="CRITICAL", h="HIGH", l="HIGH", a="MEDIUM", m="MEDIUM", w="LOW", o="OK")
    counts = {r.severity: r.alert_count for r in observe.alerts_by_severity(out).collect()}
    assert counts == dict(CRITICAL=2, HIGH=2, MEDIUM=2, LOW=1, OK=1)


@pytest.mark.parametrize("z,want", [(3.0, "EXTREME"), (-3.5, "EXTREME"), (2.0, "SIGNIFICANT"), (1.9, "NORMAL"), (None, "NORMAL")])
def test_z_severity(spark, z, want):
    df = spark.createDataFrame([(z,)], "z double")
    assert df.select(observe.z_severity(F.col("z"))).first()[0] == want


def test_day_over_day(spark):
    got = [(r.record_change, r.change_pct) for r in observe.day_over_day(metrics_frame(spark, [100, 150, 75])).collect()]
    assert got == [(None, None), (50, 50.0), (-75, -50.0)]
