"""Stored histories: merges of any split equal a rebuild, and cost what changes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_history import ARGS, DAY, SCHEMA, expected, make_events, rows

from tierstone.operators.history import filter_current, scd2_build, snapshot_diff
from tierstone.plans.flows import HistoryFlow
from tierstone.sources.commits import CommitLog, VersionTaken
from tierstone.sources.snapshots import SnapshotTable
from tierstone.sources.versions import VersionTable

FLOW = HistoryFlow(keys=ARGS["keys"], sequence="day", tracked=["kw"], drop=["loaded"], tiebreak=["loaded"])


def no_history(_):
    raise AssertionError("nothing came late")


def take(spark, table, run_id, events, seen, flow=FLOW, by=("tenant", "id")):
    df = spark.createDataFrame(events, SCHEMA)
    whole = spark.createDataFrame(seen, SCHEMA)
    return flow.take(spark, table, run_id, df, lambda k: whole.join(k, list(by), "left_semi"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stored_merges_of_any_split_equal_a_rebuild(spark, tmp_path, seed):
    """Late rows, corrections and repeats come in every run; compaction and old states change nothing."""
    events = make_events(seed, n=240)
    r = random.Random(seed)
    cuts = sorted(r.sample(range(1, 240), 3))
    parts = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 240])]
    parts[2] = parts[2] + r.sample(events[: cuts[0]], min(5, cuts[0]))
    table = FLOW.stored_in(str(tmp_path / "h"))
    seen = []
    for i, part in enumerate(parts):
        seen = seen + part
        assert take(spark, table, f"r{i}", part, seen) == i
        assert rows(table.read(spark)) == expected(seen)
        if i == 2:
            assert table.compact(spark) == 3 and rows(table.read(spark)) == expected(seen)
            table.vacuum(spark, 3)
            break
    assert rows(table.read(spark)) == expected(seen) and table.runs(spark) == ["r0", "r1", "r2"]
    version = take(spark, table, "r3", parts[3], seen + parts[3])
    assert version == 4 and rows(table.read(spark)) == expected(seen + parts[3])
    assert rows(table.read(spark, upto=3)) == expected(seen)
    assert take(spark, table, "r3", parts[3], seen) == 4


def size(root):
    return sum(p.stat().st_size for p in root.rglob("data/**/*.parquet"))


def day(i, keys, kw, first=0):
    return [("t", f"k{k:05}", DAY + dt.timedelta(days=i), kw + k % 7, f"note {k * 7919}", k) for k in range(first, first + keys)]


def test_a_merge_writes_what_changes(spark, tmp_path):
    """A few keys of every bucket have news: what is written follows their number, not that of all keys."""
    table = FLOW.stored_in(str(tmp_path / "h"))
    first = spark.createDataFrame(day(0, 20_000, 1.0), SCHEMA).coalesce(4)
    FLOW.take(spark, table, "r0", first, no_history)
    before = size(tmp_path / "h")
    news = [e for e in day(1, 20_000, 2.0) if e[5] % 100 == 0]
    FLOW.take(spark, table, "r1", spark.createDataFrame(news, SCHEMA), no_history)
    wrote = size(tmp_path / "h") - before
    assert 0 < wrote < before / 10
    assert table.open_rows(spark).count() == 20_000 and table.closed_rows(spark).count() == 200
    before = sorted(map(str, (tmp_path / "h").rglob("data/**/*.parquet")))
    FLOW.take(spark, table, "r2", spark.createDataFrame(news, SCHEMA), no_history)
    assert sorted(map(str, (tmp_path / "h").rglob("data/**/*.parquet"))) == before and table.runs(spark)[-1] == "r2"


def test_a_lookup_opens_the_files_of_its_keys(spark, tmp_path):
    """Of the retained runs as of the history, only files that span a key's bucket are read."""
    snapshots = SnapshotTable(str(tmp_path / "s"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        for i in range(3):
            snapshots.publish(spark.createDataFrame(day(i, 3_000, float(i)), SCHEMA), f"r{i}", index_by=FLOW.keys)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    one = spark.createDataFrame([("t", "k00007")], "tenant string, id string")
    assert len(snapshots.read_all(spark).inputFiles()) >= 12
    found = snapshots.read_keys(spark, one, FLOW.keys)
    assert len(snapshots.files_of_keys(spark, one, FLOW.keys)) == 3
    assert {f.rsplit("/", 1)[1] for f in found.inputFiles()} == {f.rsplit("/", 1)[1] for f in snapshots.files_of_keys(spark, one, FLOW.keys)}
    assert sorted(r.kw for r in found.collect()) == [0.0, 1.0, 2.0]
    assert snapshots.read_keys(spark, one.limit(0), FLOW.keys).count() == 0
    snapshots.publish(spark.createDataFrame(day(3, 5, 3.0, first=5), SCHEMA), "r3")
    assert sorted(r.kw for r in snapshots.read_keys(spark, one, FLOW.keys).collect()) == [0.0, 1.0, 2.0, 3.0]


@pytest.mark.parametrize("seed", [4, 5])
def test_change_log_equals_a_diff_of_states(spark, tmp_path, seed):
    events = make_events(seed, n=200)
    table = FLOW.stored_in(str(tmp_path / "h"))
    for i in range(4):
        take(spark, table, f"r{i}", events[50 * i : 50 * (i + 1)], events[: 50 * (i + 1)])
    columns = ["day", "kw", "note", "__START_AT"]
    for a, b in [(0, 3), (1, 2), (2, 3)]:
        old, new = (filter_current(scd2_build(spark.createDataFrame(events[: 50 * (i + 1)], SCHEMA), **ARGS)) for i in (a, b))
        want = snapshot_diff(old, new, ARGS["keys"], columns)
        got = table.net_changes(spark, table.version_of(spark, f"r{a}"), table.version_of(spark, f"r{b}"), columns)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


CLOSING = HistoryFlow(keys=["tenant", "id"], sequence="day", tracked=["kw"], drop=["loaded"], tiebreak=["loaded"], close_missing=["tenant"])


@pytest.mark.parametrize("seed", [6, 7, 8])
def test_snapshots_that_miss_keys_equal_a_rebuild(spark, tmp_path, seed):
    """Keys vanish and return; several snapshots come at once; one comes late."""
    r = random.Random(seed)
    order = [0, 1, 2, 3, 5, 6, 4, 7]
    snaps = {i: [
        (t, f"k{k}", DAY + dt.timedelta(days=i), r.choice([1.0, 1.0, 2.0]), r.choice(["a", "a", "b"]), i)
        for t in ("t1", "t2") for k in range(9) if r.random() < 0.7
    ] for i in order}
    table = CLOSING.stored_in(str(tmp_path / "h"))
    seen = []
    for n, ids in enumerate([[0], [1], [2, 3], [5], [6], [4], [7]]):
        part = [e for i in ids for e in snaps[i]]
        if n in (1, 3):
            part = [e for e in part if e[0] == "t1"]
        seen = seen + part
        take(spark, table, f"r{n}", part, seen, CLOSING, by=["tenant"])
        want = scd2_build(spark.createDataFrame(seen, SCHEMA), **ARGS, close_missing=["tenant"])
        assert rows(table.read(spark)) == rows(want), n
    table.compact(spark)
    assert rows(table.read(spark)) == rows(want)


def test_a_key_that_goes_on_is_not_written_again(spark, tmp_path):
    table = CLOSING.stored_in(str(tmp_path / "h"))
    CLOSING.take(spark, table, "r0", spark.createDataFrame(day(0, 5_000, 1.0), SCHEMA), no_history)
    second = [(*e[:2], DAY + dt.timedelta(days=1), *e[3:]) for e in day(0, 5_000, 1.0) if e[5] not in (7, 8)]
    CLOSING.take(spark, table, "r1", spark.createDataFrame(second, SCHEMA), no_history)
    commit = table.commits(spark)[-1]
    assert {kind: sum(f["rows"] for f in files) for kind, files in commit.files.items()} == {"open": 2, "closed": 2, "changes": 2, "scopes": 1}
    assert table.open_rows(spark).filter(F.col("day") == DAY + dt.timedelta(days=1)).count() == 4_998
    changed = table.net_changes(spark, 0, 1, ["kw"]).collect()
    assert sorted((x.id, x._change_type) for x in changed) == [("k00007", "delete"), ("k00008", "delete")]


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    table = FLOW.stored_in(str(tmp_path / "h"))
    FLOW.take(spark, table, "r0", spark.createDataFrame(day(0, 5, 1.0), SCHEMA), no_history)
    first, second = (FLOW.delta(spark, table, spark.createDataFrame(day(1, 5, kw), SCHEMA), no_history) for kw in (2.0, 3.0))
    table.publish(spark, "a", first.parts(), version=1)
    with pytest.raises(VersionTaken):
        table.publish(spark, "b", second.parts(), version=1)
    assert table.runs(spark) == ["r0", "a"] and {x.kw for x in table.open_rows(spark).collect()} == {2.0, 3.0, 4.0, 5.0, 6.0}
    later = spark.createDataFrame(day(2, 5, 3.0), SCHEMA)
    assert FLOW.take(spark, table, "b", later, no_history) == 2 and table.closed_rows(spark).count() == 10
    log = CommitLog(str(tmp_path / "log"))
    log.commit(spark, 0, [{"a": 1}, {"b": "é"}])
    with pytest.raises(VersionTaken):
        log.commit(spark, 0, [{"a": 2}])
    assert log.read(spark, log.versions(spark)) == {0: [{"a": 1}, {"b": "é"}]}


def test_a_reader_survives_a_vacuum(spark, tmp_path):
    """A state that is kept stays readable for those who planned it before files were deleted."""
    table = FLOW.stored_in(str(tmp_path / "h"))
    for i in range(3):
        FLOW.take(spark, table, f"r{i}", spark.createDataFrame(day(i, 50, float(i)), SCHEMA), no_history)
    base = table.compact(spark)
    FLOW.take(spark, table, "r3", spark.createDataFrame(day(3, 10, 9.0), SCHEMA), no_history)
    reader = table.read(spark)
    before = len(list((tmp_path / "h").rglob("data/**/*.parquet")))
    assert table.vacuum(spark, base)
    assert len(list((tmp_path / "h").rglob("data/**/*.parquet"))) < before
    assert reader.count() == table.read(spark).count() == 50 * 3 + 10
    with pytest.raises(ValueError):
        VersionTable(str(tmp_path / "none"), ["id"], "day").read(spark)
