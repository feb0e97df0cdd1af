"""Work per task stays bounded when tables grow."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierstone.operators.reshape import rollup_segments
from tierstone.operators.skew import dealt, heavy_keys


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows_per_task", [1_000_000, 100])
def test_rollup_with_and_without_heavy_keys(spark, rows_per_task):
    r = random.Random(4)
    rows = [(r.choice([None, *range(9)]) if i % 3 else 7, r.choice([None, 1.5, 2.0, 0.0, -0.0]), r.choice(["a", "b", None]), i) for i in range(900)]
    out = rollup_segments(
        spark.createDataFrame(rows, "k int, v double, s string, n int"), ["k"], mode={"v": F.col("v"), "s": F.col("s")},
        any_value={"a": F.col("s")}, total={"t": F.col("n")}, latest={"z": F.col("s")}, earliest={"e": F.col("n")},
        rows_per_task=rows_per_task,
    )

    def mode(values):
        n = Counter(x for x in values if x is not None)
        return min(n, key=lambda x: (-n[x], x)) if n else None

    def of(k):
        own = [x for x in rows if x[0] == k]
        texts = [x[2] for x in own if x[2]]
        return (k, mode([x[1] for x in own]), mode([x[2] for x in own]), min(texts), max(texts), sum(x[3] for x in own), min(x[3] for x in own))

    got = out.select("k", "v", "s", "a", "z", "t", "e").collect()
    assert {tuple(x) for x in got} == {of(k) for k in {x[0] for x in rows}} and len(got) == 10
    assert all(str(x.v) != "-0.0" for x in got)


def test_rollup_takes_one_shuffle_by_key(spark):
    df = spark.range(1000).selectExpr("id % 300 AS k", "id % 7 AS a", "id % 5 AS b")
    out = rollup_segments(df, ["k"], mode={"a": F.col("a"), "b": F.col("b")}, latest={"l": F.col("a")})
    plan = _plan(out)
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_heavy_keys_are_exact(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 300 THEN 'hot' WHEN id < 400 THEN NULL ELSE string(id) END AS k")
    assert heavy_keys(df, ["k"], 300) == (1000, None)
    rows, heavy = heavy_keys(df, ["k"], 99)
    assert rows == 1000 and {tuple(x) for x in heavy.collect()} == {("hot", 300), (None, 100)}
    assert heavy_keys(df.limit(0), ["k"], 1) == (0, None)


def test_dealt_sets_the_number_of_tasks(spark):
    df = spark.range(5000)
    assert dealt(df, ["id"], 5000, 5000) is df
    parts = dealt(df, ["id"], 5000, 250).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20


SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["hybrid_projects", "technology_distribution", "project_counts", "unresolved_projects"])
def test_projects_are_read_once(spark, name):
    from bindings import QUERIES

    plan = _plan(QUERIES[name](spark, SMALL)).split("== Initial Plan ==")[0]
    assert plan.count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["feeder_der_summary", "feeder_map_layer"])
def test_summaries_read_projects_once_per_aggregate(spark, name):
    from bindings import QUERIES

    assert _plan(QUERIES[name](spark, SMALL)).split("== Initial Plan ==")[0].count("lineitem.parquet") == 2


def test_one_frame_of_both_kinds_gives_the_same(spark):
    from bindings.serving import PART_TYPES, all_projects, projects
    from tierstone.operators import serving

    both, apart = all_projects(spark, SMALL), projects(spark, SMALL)
    for op in (serving.technology_distribution, lambda *d: serving.feeder_der_summary(*d, technologies=PART_TYPES)):
        assert sorted(map(str, op(both).collect())) == sorted(map(str, op(*apart).collect()))


def test_hybrid_projects_of_many_rows_keep_their_tasks(spark):
    from bindings.serving import all_projects
    from tierstone.operators import serving

    der = all_projects(spark, SMALL)
    plain, sized = serving.hybrid_projects(der), serving.hybrid_projects(der, 10_000_000)
    assert sorted(plain.collect()) == sorted(sized.collect())
    assert "20), REPARTITION_BY_NUM" in _plan(sized)


def test_ranks_by_steps_are_the_same(spark):
    from tierstone.sources.layout import range_rank, with_ranks

    r = random.Random(5)
    df = spark.createDataFrame([(r.choice([None, r.randrange(60)]), r.choice("abcdefgh")) for _ in range(400)], "n int, `t.x` string")
    for n in (0, 1, 2, 3, 7, 8, 20, 255):
        borders = sorted(r.randrange(60) for _ in range(n))
        texts = sorted(r.choice("bdfh") for _ in range(min(n, 5)))
        got = with_ranks(df, {"_a": ("n", borders), "_b": ("t.x", texts)})
        bad = got.filter((F.col("_a") != range_rank(F.col("n"), borders)) | (F.col("_b") != range_rank(F.col("`t.x`"), texts)))
        assert got.filter("_a IS NULL OR _b IS NULL").isEmpty() and bad.isEmpty(), n


def test_spans_cut_names_per_file(spark, tmp_path, monkeypatch):
    from tierstone.sources import layout

    path = f"{tmp_path}/a b%20"
    spark.range(2000).selectExpr("id", "id % 50 AS g").write.parquet(path)
    seen = []
    monkeypatch.setattr(layout, "plain_path", lambda c: seen.append(str(c)) or c)
    layout.write_spans(spark, path, ["g"])
    assert seen and not any("_metadata" in c for c in seen)


def test_hot_keys_are_named_only_in_full_buckets(spark, monkeypatch):
    from tierstone.operators import skew

    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS seq")
    asked = []
    plain = skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda *a: asked.append(plain(*a)) or asked[-1])
    assert skew.find_hot_keys(df, ["k"], "seq", 100) is None and asked == [(1000, None)]
    hot = skew.find_hot_keys(df, ["k"], "seq", 99)
    assert sorted(r.k for r in hot.frame.collect()) == list(range(10))


def test_index_names_are_cut_once_per_file(spark, tmp_path, monkeypatch):
    from tierstone.sources import snapshots

    seen = []
    plain = snapshots.plain_path
    monkeypatch.setattr(snapshots, "plain_path", lambda c: seen.append(str(c)) or plain(c))
    runs = snapshots.SnapshotTable(f"{tmp_path}/a b")
    rows = spark.range(500).selectExpr("id % 90 AS k", "id AS n")
    runs.publish(rows, "r 1", index_by=["k"])
    assert seen and not any("_metadata" in c for c in seen)
    wanted = spark.createDataFrame([(3,), (77,)], "k long")
    assert runs.read_keys(spark, wanted, ["k"]).count() == rows.filter("k IN (3, 77)").count()
