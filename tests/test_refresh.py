"""Landed files to serving tables: two example tenants, a second delivery, a tenant by config."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tierstone.context import RunContext
from tierstone.operators import observe
from tierstone.operators.history import filter_current
from tierstone.plans.refresh import Warehouse
from tierstone.plans.tenants import example_registry, feeder_tenant
from tierstone.sources.csv_drops import header_cells, new_column_names
from tierstone.sources.snapshots import SnapshotTable
from tierstone.streaming.ingest import RawTable, ingest_new_files
from tierstone.streaming.relay import follow_runs
from tierstone.vocab import TECHNOLOGIES

RUN1 = RunContext("run_20240115_090000_aaaaaaaa", dt.datetime(2024, 1, 15, 9))
RUN2 = RunContext("run_20240215_090000_bbbbbbbb", dt.datetime(2024, 2, 15, 9))
RAW_COLUMNS = {
    "circuits": [
        "Circuits_Phase3_CIRCUIT", "NYHCPV_csv_FVOLTAGE", "NYHCPV_csv_FMAXHC", "NYHCPV_csv_FMINHC", "NYHCPV_csv_FHCADATE",
        "NYHCPV_csv_NMAPCOLOR", "Shape_Length", "Master_CDF", "feeder_voltage", "feeder_max_hc", "feeder_min_hc",
        "hca_refresh_date", "color",
    ],
    "der_installed": ["ProjectID", "ProjectCircuitID", *TECHNOLOGIES, "DER_ID", "DER_INTERCONNECTION_LOCATION", "DER_TYPE",
                      "DER_NAMEPLATE_RATING"],
    "der_planned": ["ProjectID", "ProjectCircuitID", *TECHNOLOGIES, "InServiceDate", "INTERCONNECTION_QUEUE_REQUEST_ID",
                    "DER_INTERCONNECTION_LOCATION", "DER_TYPE", "DER_NAMEPLATE_RATING", "PLANNED_INSTALLATION_DATE"],
}
SEGMENTS = "Circuits_Phase3_CIRCUIT,NYHCPV_csv_FVOLTAGE,NYHCPV_csv_FMAXHC,NYHCPV_csv_FMINHC,NYHCPV_csv_FHCADATE,NYHCPV_csv_NMAPCOLOR,Shape_Length"
FEEDERS = ",Master_CDF,feeder_voltage,feeder_max_hc,feeder_min_hc,hca_refresh_date,color,shape_length"


def drop_file(landing, tenant, dataset, name, *lines, bom=False):
    folder = landing / tenant / dataset
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(("﻿" if bom else "") + "\n".join(lines) + "\n", encoding="utf-8")


def wide(**kw):
    return ",".join(kw.get(t, "0") for t in TECHNOLOGIES)


def first_delivery(landing):
    drop_file(landing, "utility1", "circuits", "c 1.csv", SEGMENTS,
              "c1,12.5,10.5,8.0,2022-06-30 00:00:00+00:00,0.00 TO 0.29 BROWN-953736,100.0",
              "c1,12.5,10.5,NULL,2022-07-01 00:00:00+00:00,,150.0",
              "c1,12.5,99.0,8.0,2022-06-01 00:00:00+00:00,0.00 TO 0.29 BROWN-953736,200.0",
              "c2,4,3.0,1.0,not a date,red,1.0", bom=True)
    drop_file(landing, "utility2", "circuits", "feeders.csv", FEEDERS,
              '0,36_13_81756,13.2,5.5,1.0,2022/10/01 00:00:00+00,blue,1.27',
              '1,36_13_99,13.2,n/a,1.0,2022/10/01 00:00:00+00, Light Blue ,2.5')
    head = "ProjectID,ProjectCircuitID," + ",".join(TECHNOLOGIES)
    drop_file(landing, "utility1", "der_installed", "d.csv", head, "p1,c1," + wide(SolarPV="50", EnergyStorageSystem="25"),
              "p2,NULL," + wide(Wind="7.5"))
    drop_file(landing, "utility1", "der_planned", "d.csv", head + ",InServiceDate", "p3,c1," + wide(Hydro="500") + ",2025-06-15")
    narrow = "DER_ID,DER_INTERCONNECTION_LOCATION,DER_TYPE,DER_NAMEPLATE_RATING"
    drop_file(landing, "utility2", "der_installed", "d.csv", narrow, "d1,36_13_81756,Solar,123.45", "d2,36_13_81756,Tidal,9",
              "d3,36_13_81756,,9")
    drop_file(landing, "utility2", "der_planned", "d.csv",
              "INTERCONNECTION_QUEUE_REQUEST_ID,DER_INTERCONNECTION_LOCATION,DER_TYPE,DER_NAMEPLATE_RATING,PLANNED_INSTALLATION_DATE",
              "q1,36_13_99,\"battery\",1000,6/15/2025")
    drop_file(landing, "utility9", "circuits", "x.csv", FEEDERS, "0,1_2_3,1,1,1,2022/10/01 00:00:00+00,blue,1")


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("warehouse")
    landing = base / "landing"
    first_delivery(landing)
    house = Warehouse(spark, str(base / "tables"), example_registry(), RAW_COLUMNS)
    house.refresh(str(landing), RUN1)
    return house, landing


def test_raw_rows_and_rescued_data(refreshed):
    house, _ = refreshed
    rows = house.raw("circuits").read(house.spark)
    assert rows.count() == 7
    got = {r.Master_CDF: r for r in rows.filter("Master_CDF IS NOT NULL").collect()}
    r = got["36_13_81756"]
    assert (r.Shape_Length, r._rescued_data, r._index_col_dropped, r.utility_id) == ("1.27", None, True, "utility2")
    assert r.source_file.endswith("/utility2/circuits/feeders.csv") and len(r.file_signature) == 64
    c1 = rows.filter("Circuits_Phase3_CIRCUIT = 'c1'").first()
    assert c1._index_col_dropped is False and c1.pipeline_update_id == RUN1.run_id


def test_audit_has_one_row_per_file(refreshed):
    house, _ = refreshed
    audit = house.raw("circuits").read_audit(house.spark).collect()
    assert len(audit) == 3 and {a.had_index_column_artifact for a in audit} == {0, 1}
    assert {a.file_name for a in audit} == {"c 1.csv", "feeders.csv", "x.csv"}


def test_standardized_circuits(refreshed):
    house, _ = refreshed
    got = {r.feeder_id: r for r in house.standardized("circuits").collect()}
    assert set(got) == {"utility1_c1", "utility2_36_13_81756", "utility2_36_13_99"}  # c2 has no date, utility9 no entry
    c1 = got["utility1_c1"]
    assert (c1.max_hosting_capacity_mw, c1.min_hosting_capacity_mw, c1.shape_length, c1.color_name) == (10.5, 8.0, 450.0, "BROWN")
    assert c1.hca_refresh_date == dt.datetime(2022, 7, 1) and c1.grid_area_code is None
    u2 = got["utility2_36_13_81756"]
    assert (u2.grid_state_code, u2.grid_area_code, u2.grid_circuit_id, u2.shape_length) == (36, 13, "81756", 1.27)
    assert got["utility2_36_13_99"].max_hosting_capacity_mw is None and got["utility2_36_13_99"].color_hex == "#13AFED"


def test_standardized_projects_and_quarantine(refreshed):
    house, _ = refreshed
    got = {r.der_id: r for r in house.standardized("der_installed").collect()}
    assert set(got) == {"utility1_p1_SolarPV", "utility1_p1_EnergyStorageSystem", "utility1_p2_Wind", "d1"}
    assert got["utility1_p2_Wind"].feeder_id is None and got["d1"].der_type == "SolarPV"
    bad = house.quarantine("der_installed").collect()
    assert [(b.der_id, b._failed_rules) for b in bad] == [("d2", ["canonical_der_type_only"])]
    planned = {r.der_id: r for r in house.standardized("der_planned").collect()}
    assert {r.planned_installation_date for r in planned.values()} == {dt.date(2025, 6, 15)}
    assert planned["q1"].interconnection_queue_id == "q1" and planned["q1"].der_type == "EnergyStorageSystem"


def test_metrics(refreshed):
    house, _ = refreshed
    got = {(r.utility_id, r.table_name): r for r in house.metrics().collect()}
    assert len(got) == 6
    assert got["utility1", "der_installed"].unresolved_feeder_count == 1
    assert got["utility1", "circuits"].days_since_refresh == (dt.date(2024, 1, 15) - dt.date(2022, 7, 1)).days
    (row,) = house.unmapped().collect()
    assert (row.utility_id, row.der_type, row.unmapped_count) == ("utility2", "Tidal", 1)
    drift = {r.utility_id: r.failed for r in house.drift_report("circuits").collect()}
    assert drift == {"utility1": 0, "utility2": 0, "utility9": 0}


def test_serving_tables(refreshed):
    house, _ = refreshed
    got = {r.feeder_id: r for r in house.served("feeders_with_capacity").read(house.spark).collect()}
    assert got["utility1_c1"].available_capacity_mw == pytest.approx(10.5 - 0.575)
    summary = {r.feeder_id: r for r in house.served("feeder_der_summary").read(house.spark).collect()}
    assert summary["utility1_c1"].has_hybrid_projects and summary["utility1_c1"].technology_type_count == 3
    layer = {r.feeder_id: r.map_render_level for r in house.served("feeder_map_layer").read(house.spark).collect()}
    assert layer == {"utility1_c1": "point_fallback", "utility2_36_13_81756": "district", "utility2_36_13_99": "district"}


def test_second_delivery(refreshed):
    """Only the new files are read; a column nobody knew arrives; capacity changes open a version;
    a third tenant takes part by configuration alone."""
    house, landing = refreshed
    drop_file(landing, "utility2", "circuits", "later.csv", FEEDERS + ",Owner",
              "0,36_13_81756,13.2,7.5,1.0,2023/10/01 00:00:00+00,blue,1.27,ACME")
    house.registry.register(feeder_tenant("utility9"))
    house.refresh(str(landing), RUN2)
    spark = house.spark
    raw = house.raw("circuits")
    assert raw.columns(spark)[-1] == "Owner" and raw.read(spark).count() == 8
    assert raw.read_audit(spark).count() == 4
    assert house.snapshots("circuits").runs(spark) == [RUN1.run_id, f"{RUN1.run_id}~utility9", RUN2.run_id]
    history = house.history("circuits").read(spark)
    versions = history.filter("feeder_id = 'utility2_36_13_81756'").orderBy("__START_AT").collect()
    day1, day2 = dt.datetime(2022, 10, 1), dt.datetime(2023, 10, 1)
    assert [(v.max_hosting_capacity_mw, v["__START_AT"], v["__END_AT"]) for v in versions] == [(5.5, day1, day2), (7.5, day2, None)]
    assert filter_current(history).filter("utility_id = 'utility9'").count() == 1
    rebuilt = Warehouse(spark, house.root, house.registry, RAW_COLUMNS)
    from tierstone.plans.flows import FLOWS
    for dataset, flow in FLOWS.items():
        whole = flow.build(rebuilt.retained(dataset))
        merged = house.history(dataset).read(spark)
        assert sorted(map(str, whole.select(merged.columns).collect())) == sorted(map(str, merged.collect()))


def test_refresh_again_changes_nothing(refreshed):
    house, landing = refreshed
    before = house.raw("circuits").read(house.spark).count()
    latest = house.history("circuits").runs(house.spark)
    house.ingest(str(landing), RUN2)
    house.update_history()
    assert house.raw("circuits").read(house.spark).count() == before
    assert house.history("circuits").runs(house.spark) == latest


def test_run_log_feeds_the_success_rate(refreshed):
    house, _ = refreshed
    with pytest.raises(Exception):
        Warehouse(house.spark, house.root, house.registry, {}).refresh("/nowhere", RunContext("r3", dt.datetime(2024, 2, 15, 10)))
    got = [tuple(r) for r in observe.run_success(house.run_log(), dt.date(2024, 2, 15)).collect()]
    assert got[0] == (dt.date(2024, 2, 15), 2, 1, 50.0)


def test_replayed_batch_is_written_once(spark, tmp_path):
    landing = tmp_path / "landing"
    drop_file(landing, "t", "d", "a.csv", "A,B", "1,2", "3,4")
    table = RawTable(str(tmp_path / "raw"), "d", ["A"])
    path = f"{landing}/t/d/a.csv"
    table.write_batch(spark, [path], 0, RUN1)
    table.write_batch(spark, [path], 0, RUN2)
    rows = table.read(spark).collect()
    assert len(rows) == 2 and {r.pipeline_update_id for r in rows} == {RUN1.run_id} and rows[0].B in ("2", "4")


def test_files_with_different_headers_do_not_mix(spark, tmp_path):
    landing = tmp_path / "landing"
    drop_file(landing, "t", "d", "a.csv", "id,len", "x,1.5")
    drop_file(landing, "t", "d", "b.csv", "len,id", "2.5,y")
    drop_file(landing, "u", "d", "c.csv", '"i,d",id', '"q ""1""",z')
    table = RawTable(str(tmp_path / "raw"), "d", ["id", "len"], evolve=False)
    ingest_new_files(spark, str(landing), table, str(tmp_path / "cp"), RUN1)
    got = {(r.id, r.len) for r in table.read(spark).collect()}
    assert got == {("x", "1.5"), ("y", "2.5"), ("z", None)}
    drift = table.read(spark).filter("_rescued_data IS NOT NULL").select(F.from_json("_rescued_data", "map<string,string>")).first()[0]
    assert drift["i,d"] == 'q "1"' and drift["_file_path"].endswith("c.csv")


def test_header_cells():
    assert header_cells('﻿,"a,b", c ,c') == ["_c0", "a,b", "c", "c_3"]
    assert new_column_names([",a,B", "b,New"], ["A"]) == ["B", "New"]


def test_published_runs_are_immutable_and_followed_once(spark, tmp_path):
    table, seen = SnapshotTable(str(tmp_path / "t")), []
    assert table.runs(spark) == []
    with pytest.raises(ValueError):
        table.read(spark)
    follow = lambda: follow_runs(spark, table, str(tmp_path / "cp"), lambda df, run: seen.append((run, df.count())))
    table.publish(spark.range(3).toDF("a"), "r1")
    table.publish(spark.range(9).toDF("a"), "r1")
    follow()
    table.publish(spark.range(5).selectExpr("id AS a", "'x' AS b"), "r2", cluster_by=["b", "a"])
    follow()
    follow()
    assert seen == [("r1", 3), ("r2", 5)]
    assert table.read(spark).count() == 5 and table.read(spark, "r1").count() == 3
    assert table.read_all(spark).filter("b IS NULL").count() == 3


def test_registry_errors(spark):
    registry = example_registry()
    assert registry.is_utility_registered("utility1") and not registry.is_utility_registered("x")
    assert list(registry.get_registered_utilities()) == ["utility1", "utility2"]
    with pytest.raises(ValueError):
        registry.standardize(spark.range(1), "weather")


def test_segments_delivered_again(spark, tmp_path):
    """The same segments with a later date give a newer row, no doubled sum and no version; metrics stay one row per
    (run, table, tenant); each run is judged."""
    landing = tmp_path / "landing"
    house = Warehouse(spark, str(tmp_path / "tables"), example_registry(), RAW_COLUMNS)
    first_delivery(landing)
    house.refresh(str(landing), RUN1)
    runs = [RUN1]
    for month in (2, 3):
        run = RunContext(f"run_2024{month:02}15_090000_cccccccc", dt.datetime(2024, month, 15, 9))
        drop_file(landing, "utility1", "circuits", f"c{month}.csv", SEGMENTS,
                  *[f"c1,12.5,10.5,8.0,2022-{6 + month:02}-0{i} 00:00:00+00:00,0.00 TO 0.29 BROWN-953736,{n}"
                    for i, n in ((1, 100.0), (2, 150.0), (3, 200.0))])
        house.refresh(str(landing), run)
        runs.append(run)
    versions = house.history("circuits").read(spark).filter("feeder_id = 'utility1_c1'").collect()
    assert [(v.shape_length, v["__END_AT"]) for v in versions] == [(450.0, None)]
    metrics = house.metrics()
    keys = ["pipeline_update_id", "table_name", "utility_id"]
    assert metrics.count() == metrics.select(keys).distinct().count() == 8
    for run in runs:
        judged = observe.volume_baseline(metrics, run.as_of)
        assert judged.filter("table_name = 'circuits' AND utility_id = 'utility1'").count() == 1
    assert observe.alert_severity(metrics, observe.volume_baseline(metrics)).count() == metrics.count()
    files = lambda: sorted(str(p) for p in (tmp_path / "tables" / "history").rglob("data/**/*.parquet"))
    before = files()
    drop_file(landing, "utility2", "circuits", "same.csv", FEEDERS, '0,36_13_81756,13.2,5.5,1.0,2022/10/01 00:00:00+00,blue,1.27')
    house.refresh(str(landing), RunContext("run_20240415_090000_dddddddd", dt.datetime(2024, 4, 15, 9)))
    assert files() == before and house.history("circuits").runs(spark)[-1] == "run_20240415_090000_dddddddd"
    lost = {(r.of_table, r.utility_id, r.rule_name): r.failed for r in house.losses().filter(f"run_id = '{RUN1.run_id}'").collect()}
    assert lost["circuits", "utility1", "valid_hca_refresh_date"] == 1 and lost["circuits", "utility9", "registered_utility"] == 1
    assert lost["der_installed", "utility2", "canonical_der_type_only"] == 2
    assert lost["circuits", "utility1", "parsed_voltage_kv"] == lost["der_planned", "utility2", "parsed_planned_installation_date"] == 0


def test_parses_that_lose_a_value_are_stored(spark, tmp_path):
    landing = tmp_path / "landing"
    house = Warehouse(spark, str(tmp_path / "tables"), example_registry(), RAW_COLUMNS)
    drop_file(landing, "utility2", "circuits", "a.csv", FEEDERS, "0,36_13_1,high,5.5,1.0,2022/10/01 00:00:00+00,blue,1.27",
              "1,36_13_2,13.2,5.5,n.a.,01.10.2022,blue,1.27", "2,36_13_3,13.2,5.5,,2022/10/01 00:00:00+00,blue,1.27")
    drop_file(landing, "utility2", "der_installed", "d.csv", "DER_ID,DER_INTERCONNECTION_LOCATION,DER_TYPE,DER_NAMEPLATE_RATING",
              "d1,36_13_1,Solar,much", "d2,36_13_1,Solar,2", "d3,36_13_1,Solar,")
    house.ingest(str(landing), RUN1)
    house.standardize(RUN1)
    lost = {(r.of_table, r.rule_name): (r.checked, r.failed) for r in house.losses().collect()}
    assert lost["circuits", "parsed_voltage_kv"] == (3, 1) and lost["circuits", "parsed_min_hosting_capacity_mw"] == (3, 1)
    assert lost["circuits", "parsed_hca_refresh_date"] == (3, 1) and lost["circuits", "parsed_shape_length"] == (3, 0)
    assert lost["circuits", "valid_hca_refresh_date"] == (3, 1) and lost["der_installed", "parsed_nameplate_rating_kw"] == (3, 1)
    assert house.standardized("circuits").columns == house.registry.standardize(house.raw("circuits").read(spark), "circuits").columns


def test_imperfect_files_lose_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    table = RawTable(str(tmp_path / "raw"), "d", ["A", "B"])
    drop_file(landing, "t", "d", "now.csv", "A,B", "1,2")
    ingest_new_files(spark, str(landing), table, str(tmp_path / "cp"), RUN1)
    drop_file(landing, "t", "d", "old.csv", "A,B", "3,4")
    os.utime(landing / "t" / "d" / "old.csv", (1.6e9, 1.6e9))
    drop_file(landing, "t", "d", "x[1] {2} 100%25.csv", "", "  ", "A,B", "5,6", '7,8,"EXTRA, 1",MORE')
    drop_file(landing, "t", "d", "clash.csv", "A,batch_id,Utility_ID,source_file", "9,77,zz,s")
    drop_file(landing, "t", "d", "head.csv", "A,B")
    for _ in range(2):
        ingest_new_files(spark, str(landing), table, str(tmp_path / "cp"), RUN2)
    got = {r.A: r for r in table.read(spark).collect()}
    assert set(got) == {"1", "3", "5", "7", "9"} and got["5"].B == "6" and got["5"]._rescued_data is None
    assert json.loads(got["7"]._rescued_data)["_long_row"] == '7,8,"EXTRA, 1",MORE'
    rescued = json.loads(got["9"]._rescued_data)
    assert (rescued["batch_id"], rescued["Utility_ID"], rescued["source_file"]) == ("77", "zz", "s")
    assert got["9"].utility_id == "t" and got["9"].B is None
    names = [r.file_name for r in table.read_audit(spark).collect()]
    assert sorted(names) == sorted(["now.csv", "old.csv", "x[1] {2} 100%25.csv", "clash.csv", "head.csv"])
    signed = {r.file_signature for r in table.read_audit(spark).collect()}
    assert {r.file_signature for r in got.values()} <= signed and len(signed) == 5


def test_a_file_in_the_audit_is_not_stored_again(spark, tmp_path):
    landing = tmp_path / "landing"
    drop_file(landing, "t", "d", "a.csv", "A", "1")
    table = RawTable(str(tmp_path / "raw"), "d", ["A"])
    for checkpoint in ("one", "two"):  # a lost checkpoint lists everything anew
        ingest_new_files(spark, str(landing), table, str(tmp_path / checkpoint), RUN1)
    table.write_batch(spark, [f"{landing}/t/d/a.csv"], 7, RUN2)
    assert table.read(spark).count() == 1 and table.read_audit(spark).count() == 1
