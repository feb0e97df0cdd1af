"""Type-2 history against a row-by-row reference in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierstone.operators.history import (
    as_of, as_of_join, filter_current, scd2_build, scd2_merge, snapshot_diff, unkeyed_rows, unseen_events,
)
from tierstone.operators.skew import find_hot_keys
from tierstone.sources.shared import cut_lineage

DAY = dt.date(2024, 1, 1)
SCHEMA = "tenant string, id string, day date, kw double, note string, loaded int"
ARGS = dict(keys=["tenant", "id"], sequence="day", tracked=["kw"], drop=["loaded"], tiebreak=["loaded"])


def make_events(seed, n=400, keys=6, days=40):
    r = random.Random(seed)
    return [
        (
            r.choice(["t1", "t2"]),
            f"k{min(r.randrange(keys), r.randrange(keys))}",
            DAY + dt.timedelta(days=r.randrange(days)),
            r.choice([None, 1.0, 1.0, 2.0]),
            f"n{r.randrange(5)}",
            i,
        )
        for i in range(n)
    ]


def expected(events, untracked="update"):
    best = {}
    for e in events:
        if e[0] is None or e[1] is None or e[2] is None:
            continue
        key = e[:3]
        if key not in best or e[5] > best[key][5]:
            best[key] = e
    out, open_row = [], {}
    for e in sorted(best.values(), key=lambda e: e[:3]):
        k = e[:2]
        cur = open_row.get(k)
        same = cur is not None and cur["kw"] == e[3] and untracked == "update"
        if same:
            cur.update(day=e[2], note=e[4])
        else:
            if cur is not None:
                cur["end"] = e[2]
            open_row[k] = dict(tenant=e[0], id=e[1], day=e[2], kw=e[3], note=e[4], start=e[2], end=None)
            out.append(open_row[k])
    return sorted((tuple(v.values()) for v in out), key=str)


def rows(df):
    df = df.select("tenant", "id", "day", "kw", "note", "__START_AT", "__END_AT")
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 15, 1])
def test_build_matches_row_by_row(spark, rows_per_task):
    events = make_events(1)
    df = spark.createDataFrame(events, SCHEMA)
    assert rows(scd2_build(df, **ARGS, rows_per_task=rows_per_task)) == expected(events)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 15])
def test_untracked_version_opens_every_day(spark, rows_per_task):
    events = make_events(2)
    df = spark.createDataFrame(events, SCHEMA)
    got = rows(scd2_build(df, **ARGS, untracked="version", rows_per_task=rows_per_task))
    assert got == expected(events, "version")


def test_arrival_order_does_not_matter(spark):
    events = make_events(3)
    shuffled = events[:]
    random.Random(0).shuffle(shuffled)
    a = scd2_build(spark.createDataFrame(events, SCHEMA), **ARGS)
    b = scd2_build(spark.createDataFrame(shuffled, SCHEMA), **ARGS)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("seed,rows_per_task", [(4, 2_000_000), (5, 2_000_000), (6, 10)])
def test_merge_of_any_split_equals_rebuild(spark, seed, rows_per_task):
    events = make_events(seed, n=300)
    r = random.Random(seed)
    cuts = sorted(r.sample(range(1, 300), 2))
    parts = [events[: cuts[0]], events[cuts[0] : cuts[1]], events[cuts[1] :]]
    seen = parts[0]
    target = cut_lineage(scd2_build(spark.createDataFrame(seen, SCHEMA), **ARGS, rows_per_task=rows_per_task))
    for part in parts[1:]:
        seen = seen + part
        target = cut_lineage(scd2_merge(
            target, spark.createDataFrame(part, SCHEMA), history=spark.createDataFrame(seen, SCHEMA),
            **ARGS, rows_per_task=rows_per_task,
        ))
    assert rows(target) == expected(events)


def test_merge_in_order_needs_no_history(spark):
    events = sorted(make_events(7, n=200), key=lambda e: e[2])
    cut = next(i for i, e in enumerate(events) if e[2] > DAY + dt.timedelta(days=20))
    target = scd2_build(spark.createDataFrame(events[:cut], SCHEMA), **ARGS)
    merged = scd2_merge(
        target, spark.createDataFrame(events[cut:], SCHEMA), history=spark.createDataFrame([], SCHEMA), **ARGS
    )
    assert rows(merged) == expected(events)


@pytest.mark.parametrize("untracked, rows_per_task", [("update", 2_000_000), ("version", 5)])
def test_merge_of_whole_snapshots_needs_history_only_for_corrections(spark, untracked, rows_per_task):
    """A snapshot that repeats everything seen and adds later days never reads the history."""
    events = sorted(make_events(9, n=250), key=lambda e: (e[2], e[5]))
    days = sorted({e[2] for e in events})
    upto = lambda d: [e for e in events if e[2] <= d]
    first, last = days[len(days) // 2], days[-1]
    args = dict(ARGS, untracked=untracked, rows_per_task=rows_per_task)
    target = cut_lineage(scd2_build(spark.createDataFrame(upto(first), SCHEMA), **args))
    unread = spark.createDataFrame([], SCHEMA)
    # copies of one key and day that lost their tie are corrections to the merge, so leave them out
    winners = list({e[:3]: e for e in upto(last)}.values())
    merged = cut_lineage(scd2_merge(target, spark.createDataFrame(winners, SCHEMA), history=unread, **args))
    assert rows(merged) == expected(events, untracked)
    again = scd2_merge(merged, spark.createDataFrame(winners, SCHEMA), history=unread, **args)
    assert rows(again) == expected(events, untracked)


def test_more_hot_keys_than_fit_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tierstone.operators.skew.MAX_HOT_KEYS", 2)
    events = make_events(21, n=300)
    assert rows(scd2_build(spark.createDataFrame(events, SCHEMA), **ARGS, rows_per_task=10)) == expected(events)


def test_repeated_snapshot_of_a_hot_key_is_no_news(spark):
    events = sorted(make_events(11, n=200), key=lambda e: (e[2], e[5]))
    winners = spark.createDataFrame(list({e[:3]: e for e in events}.values()), SCHEMA)
    target = scd2_build(winners, **ARGS)
    for rows_per_task in (2_000_000, 3):
        news = unseen_events(target, winners, ARGS["keys"], "day", ARGS.get("tracked"), ARGS.get("drop", ()), rows_per_task=rows_per_task)
        assert news.count() == 0


@pytest.mark.parametrize("seed", [12])
def test_merge_that_closes_missing_keys_equals_rebuild(spark, seed):
    events = sorted(make_events(seed, n=120), key=lambda e: (e[2], e[5]))
    cut = len(events) // 2
    args = dict(ARGS, close_missing=["tenant"])
    whole = spark.createDataFrame(events, SCHEMA)
    target = scd2_build(spark.createDataFrame(events[:cut], SCHEMA), **args)
    merged = scd2_merge(target, spark.createDataFrame(events[cut:], SCHEMA), history=whole, **args)
    assert rows(merged) == rows(scd2_build(whole, **args))


def test_versions_are_contiguous_and_one_is_open(spark):
    got = rows(scd2_build(spark.createDataFrame(make_events(8), SCHEMA), **ARGS))
    by_key = {}
    for r in sorted(got, key=lambda r: (r[0], r[1], r[5])):
        by_key.setdefault(r[:2], []).append(r)
    for versions in by_key.values():
        assert [v[6] for v in versions[:-1]] == [v[5] for v in versions[1:]]
        assert versions[-1][6] is None
        assert all(a[3] != b[3] for a, b in zip(versions, versions[1:]))


def test_null_keys_are_left_out_and_reported(spark):
    df = spark.createDataFrame(
        [("t1", None, DAY, 1.0, "a", 1), ("t1", "k", DAY, 1.0, "a", 1), ("t1", "k", None, 1.0, "a", 1)], SCHEMA
    )
    assert scd2_build(df, **ARGS).count() == 1
    assert unkeyed_rows(df, ARGS["keys"], "day").count() == 2


@pytest.mark.parametrize("rows_per_task", [2_000_000, 1])
def test_close_missing(spark, rows_per_task):
    d = [DAY + dt.timedelta(days=i) for i in range(4)]
    events = [("t1", "a", d[0], 1.0, "x", 1), ("t1", "b", d[0], 1.0, "x", 1), ("t1", "a", d[1], 1.0, "x", 2),
              ("t1", "b", d[2], 1.0, "x", 3), ("t1", "a", d[2], 1.0, "x", 3), ("t2", "a", d[3], 1.0, "x", 3),
              ("t1", "b", d[3], 1.0, "x", 4)]
    out = scd2_build(spark.createDataFrame(events, SCHEMA), **ARGS, close_missing=["tenant"], rows_per_task=rows_per_task)
    got = {(r.tenant, r.id, r["__START_AT"], r["__END_AT"]) for r in out.collect()}
    assert got == {
        ("t1", "a", d[0], d[3]), ("t1", "b", d[0], d[1]), ("t1", "b", d[2], None), ("t2", "a", d[3], None),
    }


def test_same_sequence_keeps_the_last_run(spark):
    df = spark.createDataFrame([("t1", "k", DAY, 1.0, "a", 1), ("t1", "k", DAY, 2.0, "b", 2)], SCHEMA)
    got = rows(scd2_build(df, **ARGS))
    assert got == [("t1", "k", DAY, 2.0, "b", DAY, None)]


def test_current_and_as_of(spark):
    events = [("t1", "k", DAY, 1.0, "a", 1), ("t1", "k", DAY + dt.timedelta(days=5), 2.0, "b", 2)]
    out = scd2_build(spark.createDataFrame(events, SCHEMA), **ARGS)
    assert [r.kw for r in filter_current(out).collect()] == [2.0]
    lower = out.withColumnRenamed("__END_AT", "__end_at")
    assert [r.kw for r in filter_current(lower).collect()] == [2.0]
    at = lambda n: [r.kw for r in as_of(out, F.lit(DAY + dt.timedelta(days=n))).collect()]
    assert (at(-1), at(0), at(4), at(5), at(9)) == ([], [1.0], [1.0], [2.0], [2.0])
    with pytest.raises(ValueError, match="__END_AT"):
        filter_current(out.drop("__END_AT"))


def test_dropping_the_sequence_is_refused(spark):
    df = spark.createDataFrame(make_events(1, 3), SCHEMA)
    with pytest.raises(ValueError):
        scd2_build(df, ["id"], "day", drop=["day"])


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "id int, v string, w int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 1)], "id int, v string, w int")
    got = {tuple(r) for r in snapshot_diff(old, new, ["id"], ["v", "w"]).collect()}
    assert got == {
        (2, "b", 1, "update_pre"), (2, "B", 1, "update_post"), (3, "c", 1, "delete"), (4, "d", 1, "insert"),
    }


@pytest.mark.parametrize("rows_per_task", [2_000_000, 10])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_as_of_join_finds_the_version_of_each_moment(spark, rows_per_task, how):
    r = random.Random(9)
    versions = expected(make_events(9))
    history = spark.createDataFrame(versions, "tenant string, id string, day date, kw double, note string, `__START_AT` date, `__END_AT` date")
    history = history.filter("NOT (id = 'k1' AND dayofmonth(`__START_AT`) % 3 = 0)")
    kept = [tuple(x) for x in history.collect()]
    probes = [(i, r.choice(["t1", "t2", "t3", None]), f"k{r.randrange(6)}", r.choice([None, *[DAY + dt.timedelta(days=d) for d in range(-2, 45)]])) for i in range(400)]
    df = spark.createDataFrame(probes, "probe int, tenant string, id string, at date")
    got = as_of_join(df, "at", history, ["tenant", "id"], ["kw", "note"], how, rows_per_task)
    want = []
    for p in probes:
        hit = [v for v in kept if p[3] is not None and v[:2] == p[1:3] and v[5] <= p[3] and (v[6] is None or v[6] > p[3])]
        assert len(hit) <= 1
        if hit or how == "left":
            want.append((*p, *(hit[0][3:5] if hit else (None, None))))
    assert got.columns == ["probe", "tenant", "id", "at", "kw", "note"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(ValueError):
        as_of_join(df.withColumnRenamed("probe", "kw"), "at", history, ["tenant", "id"], ["kw"])


@pytest.mark.parametrize("seed", [10, 11])
def test_text_sequences_are_cut_like_any_other(spark, seed):
    """A key of very many rows whose sequence is text: split by force, it equals the plain plan."""
    events = [(*e[:2], f"2024-{e[2]:%m-%d}T{'é' if i % 3 else ''}", *e[3:]) for i, e in enumerate(make_events(seed, n=500, keys=2))]
    df = cut_lineage(spark.createDataFrame(events, SCHEMA.replace("day date", "day string")))
    plain = scd2_build(df, **ARGS)
    assert find_hot_keys(df, ARGS["keys"], "day", 20) is not None
    for rows_per_task in (20, 3):
        assert rows(scd2_build(df, **ARGS, rows_per_task=rows_per_task)) == rows(plain)
    first = cut_lineage(scd2_build(df.filter("loaded < 250"), **ARGS))
    merged = scd2_merge(first, df.filter("loaded >= 250"), history=df, **ARGS, rows_per_task=5)
    assert rows(merged) == rows(plain)
