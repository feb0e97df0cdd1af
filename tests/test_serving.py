import datetime as dt

import pytest

from tierstone.operators import serving

T0 = dt.datetime(2024, 1, 1)
CIRCUIT = ("feeder_id string, utility_id string, native_feeder_id string, voltage_kv double, max_hosting_capacity_mw double, "
           "min_hosting_capacity_mw double, hca_refresh_date timestamp, color_code string, color_hex string, color_name string, "
           "shape_length double, grid_state_code int, grid_area_code int, grid_circuit_id string, geom_wkt string, "
           "__START_AT timestamp, __END_AT timestamp")
DER = "utility_id string, der_id string, feeder_id string, der_type string, nameplate_rating_kw double, __END_AT timestamp"


def circuit(feeder, mw, end=None, area=None, wkt=None):
    return (feeder, "u", feeder, 12.0, mw, 1.0, T0, "blue", "#0070C0", "BLUE", 5.0, None, area, None, wkt, T0, end)


@pytest.fixture()
def tables(spark):
    circuits = spark.createDataFrame([
        circuit("f1", 10.0), circuit("f1", 99.0, end=T0), circuit("f2", 10.0, area=7), circuit("f3", None, area=7, wkt="POINT(0 0)"),
    ], CIRCUIT)
    installed = spark.createDataFrame([
        ("u", "p1_SolarPV", "f1", "SolarPV", 2000.0, None), ("u", "p1_Wind", "f1", "Wind", 1000.0, None),
        ("u", "old_Wind", "f1", "Wind", 5000.0, T0), ("u", "p9_Wind", None, "Wind", 7.0, None),
        ("u", "p4_Other", "f3", "Other", None, None), ("v", "p5_Wind", "f1", "Wind", 1.0, None),
    ], DER)
    planned = spark.createDataFrame([("u", "q1", "f2", "SolarPV", 12000.0, None), ("u", "p1_SolarPV", "f1", "SolarPV", 1.0, None)], DER)
    return circuits, installed, planned


def test_capacity_view(tables):
    got = {r.feeder_id: r for r in serving.feeders_with_capacity(*tables).collect()}
    assert set(got) == {"f1", "f2", "f3"} and len(got["f1"]) == 18
    f1 = got["f1"]
    assert (f1.installed_der_count, f1.installed_capacity_kw, f1.planned_der_count, f1.total_der_count) == (2, 3000.0, 1, 3)
    assert f1.available_capacity_mw == pytest.approx(6.999)
    assert got["f2"].available_capacity_mw == -2.0 and got["f2"].installed_capacity_kw == 0.0
    assert got["f3"].available_capacity_mw is None and got["f3"].installed_der_count == 1


def test_summary(tables):
    got = {(r.utility_id, r.feeder_id): r for r in serving.feeder_der_summary(*tables[1:]).collect()}
    assert set(got) == {("u", "f1"), ("u", "f2"), ("u", "f3"), ("v", "f1")}
    f1 = got["u", "f1"]
    assert len(f1) == 2 + 6 + 28 + 2
    assert (f1.total_der_count, f1.unique_project_count, f1.installed_count, f1.planned_count) == (3, 2, 2, 1)
    assert (f1.solarpv_count, f1.solarpv_capacity_kw, f1.wind_capacity_kw, f1.hydro_count, f1.hydro_capacity_kw) == (2, 2001.0, 1000.0, 0, 0)
    assert f1.technology_type_count == 2 and f1.has_hybrid_projects and not got["u", "f2"].has_hybrid_projects
    f3 = got["u", "f3"]
    assert (f3.installed_capacity_kw, f3.planned_capacity_kw, f3.other_capacity_kw, f3.wind_capacity_kw) == (None, 0.0, None, 0.0)


def test_map_layer(tables):
    layer = serving.feeder_map_layer(tables[0], serving.feeder_der_summary(*tables[1:]))
    got = {r.feeder_id: r for r in layer.collect()}
    assert len(layer.columns) == 20
    assert {k: r.map_render_level for k, r in got.items()} == {"f1": "point_fallback", "f2": "district", "f3": "geometry"}
    assert got["f1"].available_capacity_mw == pytest.approx(6.999) and got["f1"].data_as_of_date == T0
    assert [r.feeder_id for r in serving.map_slice(layer, "u", [7, 8]).orderBy("feeder_id").collect()] == ["f2", "f3"]


def test_lookups(tables):
    feeders = serving.feeders_with_capacity(*tables)
    assert [r.feeder_id for r in serving.with_min_capacity(feeders, 5.0, "u").collect()] == ["f1"]
    assert serving.with_min_capacity(feeders, 5.0, "x").count() == 0
    assert [r.feeder_id for r in serving.with_available_capacity(feeders).collect()] == ["f1"]
    ranks = {r.feeder_id: r.capacity_rank for r in serving.rank_by_capacity(feeders).collect()}
    assert ranks == {"f1": 1, "f2": 2, "f3": 3}
    assert [r.feeder_id for r in serving.top_by_capacity(feeders, 1).collect()] == ["f1"]
    assert serving.der_of_feeder(*tables[1:], feeder_id="f1").count() == 4


def test_projects_and_orphans(spark, tables):
    circuits, installed, planned = tables
    assert {(r.project_id, r.technology_count) for r in serving.hybrid_projects(installed).collect()} == {("p1", 2)}
    counts = {(r.utility_id, r.feeder_id): (r.der_rows, r.project_count) for r in serving.project_counts(installed).collect()}
    assert counts["u", "f1"] == (3, 2)
    lost = serving.orphans(installed, circuits.filter("feeder_id <> 'f3'"), serving.FEEDER_KEY)
    assert {r.der_id for r in lost.collect()} == {"p4_Other", "p5_Wind"}
    assert [r.der_id for r in serving.unresolved(installed, serving.FEEDER_KEY).collect()] == ["p9_Wind"]


def test_empty_der(tables):
    circuits, installed, planned = tables
    none = installed.limit(0)
    assert {r.total_der_capacity_kw for r in serving.feeders_with_capacity(circuits, none, none).collect()} == {0.0}
    assert serving.feeder_der_summary(none, none).count() == 0
