import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierstone.operators.reshape import rollup_segments, unpivot_positive
from tierstone.plans.canonical import canonical_circuits
from tierstone.plans.layouts import feeder_rows, segment_rows
from tierstone.sources.layout import clustered
from tierstone.operators.skew import SEGMENT, cut_into_bins, find_hot_keys, only_hot_keys, rank_within, segment_of, top_within, with_neighbours, with_next_two


def test_rollup_of_three_segments(spark):
    rows = [
        ("c1", "10.5", None, "2022-01-01", 100.0), ("c1", "10.5", "8.0", "2022-06-30", 150.0), ("c1", "99.0", "8.0", "2022-03-01", 200.0),
        ("c2", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "k string, hc string, low string, d string, len double")
    out = rollup_segments(
        df, ["k"], mode={"hc": F.col("hc"), "low": F.col("low")}, any_value={"first_d": F.col("d")},
        total={"len": F.col("len")}, latest={"last_d": F.col("d")}, earliest={"low_len": F.col("len")},
    )
    got = {r.k: r.asDict() for r in out.collect()}
    assert got["c1"] == dict(k="c1", hc="10.5", low="8.0", first_d="2022-01-01", last_d="2022-06-30", len=450.0, low_len=100.0)
    assert got["c2"] == dict(k="c2", hc=None, low=None, first_d=None, last_d=None, len=None, low_len=None)


def test_mode_against_counting(spark):
    r = random.Random(1)
    rows = [(r.randrange(20), r.choice([None, 1, 2, 3, 4]), r.choice(["a", "b", "c"])) for _ in range(600)]
    out = rollup_segments(
        spark.createDataFrame(rows, "k int, v int, s string"), ["k"], mode={"v": F.col("v"), "s": F.col("s")}
    )

    def mode(values):
        n = Counter(x for x in values if x is not None)
        return min(n, key=lambda x: (-n[x], x)) if n else None

    keys = {k for k, _, _ in rows}
    assert {tuple(x) for x in out.collect()} == {
        (k, mode([v for a, v, _ in rows if a == k]), mode([s for a, _, s in rows if a == k])) for k in keys
    }


def test_rollup_without_mode_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    out = rollup_segments(df, ["k"], total={"t": F.col("v")}, latest={"m": F.col("v")})
    assert out.collect() == [("a", 3, 2)]


def test_unpivot_keeps_positive_numbers(spark):
    df = spark.createDataFrame([("p1", "50", "25", "0"), ("p2", "x", None, "-1")], "id string, A string, B string, C string")
    out = unpivot_positive(df, ["id"], ["A", "B", "C"], "type", "kw")
    assert sorted(tuple(r) for r in out.collect()) == [("p1", "A", 50.0), ("p1", "B", 25.0)]


def test_rank_matches_window(spark):
    r = random.Random(2)
    rows = [
        (i, r.choice(["a", "b", None]), r.choice([None, 1e12, 5.0, r.random(), round(r.random(), 1), -r.random()]))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "id int, t string, v double")
    want = df.withColumn("rank", F.expr("rank() over (partition by t order by v desc nulls last)"))
    got = rank_within(df, ["t"], "v")
    assert {x.id: x["rank"] for x in got.collect()} == {x.id: x["rank"] for x in want.collect()}
    assert got.count() == 900


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_matches_window(spark, k):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, 9.0, 8.0, 8.0, r.random()])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t string, v double")
    want = df.withColumn("rank", F.expr("rank() over (partition by t order by v desc nulls last)")).filter(F.col("rank") <= k)
    assert {(x.id, x["rank"]) for x in top_within(df, ["t"], "v", k).collect()} == {(x.id, x["rank"]) for x in want.collect()}


def test_rank_of_decimals(spark):
    df = spark.sql("SELECT 'a' t, CAST(id % 7 AS DECIMAL(18,2)) v, id FROM range(30)")
    want = df.withColumn("rank", F.expr("rank() over (partition by t order by v desc)"))
    assert {(x.id, x["rank"]) for x in rank_within(df, ["t"], "v").collect()} == {
        (x.id, x["rank"]) for x in want.collect()
    }


def test_segment_of_counts_the_points_below(spark):
    points = F.array(*[F.lit(float(x)) for x in (1, 3, 3, 5, 7, 7, 9)])
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS at FROM range(11)")
    got = [r[0] for r in df.orderBy("at").select(segment_of(points, F.col("at"), 8)).collect()]
    assert got == [sum(p <= at for p in (1, 3, 3, 5, 7, 7, 9)) for at in range(11)]


@pytest.fixture()
def hot_rows(spark):
    """One key with most of the rows, half of them at one end of its span."""
    df = spark.sql("""
        SELECT 'hot' AS k, CAST(CASE WHEN id % 2 = 0 THEN id ELSE 1000000 + id * 1000 END AS BIGINT) AS seq FROM range(400)
        UNION ALL SELECT CONCAT('k', id), id FROM range(20)""")
    return df


def test_only_heavy_keys_are_hot(spark, hot_rows):
    hot = find_hot_keys(hot_rows, ["k"], "seq", rows_per_task=100)
    assert [r.k for r in hot.frame.collect()] == ["hot"]
    assert find_hot_keys(hot_rows, ["k"], "seq", rows_per_task=1000) is None
    assert find_hot_keys(hot_rows.withColumn("seq", F.col("seq").cast("string")), ["k"], "seq", 100) is None


def test_segments_are_ordered_and_balanced(spark, hot_rows):
    hot = find_hot_keys(hot_rows, ["k"], "seq", rows_per_task=30)
    rows = only_hot_keys(hot_rows, hot, ["k"], "seq").orderBy("seq").collect()
    segments = [r[SEGMENT] for r in rows]
    assert len(rows) == 400 and segments == sorted(segments) and hot.cuts == 16
    assert max(Counter(segments).values()) <= 30


def test_neighbours_cross_segment_borders(spark, hot_rows):
    hot = find_hot_keys(hot_rows, ["k"], "seq", rows_per_task=3)
    rows = only_hot_keys(hot_rows, hot, ["k"], "seq")
    plain = hot_rows.filter("k = 'hot'")
    value = F.struct("seq")

    def found(df):
        return sorted(map(str, df.drop(SEGMENT).collect()))

    assert found(with_neighbours(rows, ["k"], "seq", value)) == found(with_neighbours(plain, ["k"], "seq", value))
    assert found(with_next_two(rows, ["k"], "seq", value)) == found(with_next_two(plain, ["k"], "seq", value))


def test_unpivot_leaves_out_what_is_no_finite_number(spark):
    df = spark.createDataFrame([(1, "NaN", "Infinity", "2.5", "-1", None, "x")], "id int, a string, b string, c string, d string, e string, f string")
    assert [tuple(r) for r in unpivot_positive(df, ["id"], list("abcdef"), "m", "v").collect()] == [(1, "c", 2.5)]


def test_clustered_takes_any_schema(spark):
    df = spark.range(20).selectExpr("id AS k", "map('a', id) AS m", "array(map('b', id)) AS am", "struct(id AS `x.y`) AS s", "id AS `a.b`")
    assert clustered(df, ["k"]).count() == 20


def test_geometry_comes_through_the_layouts(spark):
    raw = spark.createDataFrame(
        [("u", "f1", "POINT (1 2)", "r1"), ("u", "f1", "POINT (1 2)", "r2")], "utility_id string, feeder string, shape string, pipeline_update_id string"
    ).withColumns({"ingestion_timestamp": F.lit(dt.datetime(2024, 1, 1)), "ingestion_date": F.lit(dt.date(2024, 1, 1))})
    for layout in (feeder_rows("feeder", {"geom_wkt": "shape"}), segment_rows("feeder", {"geom_wkt": "shape"})):
        rows = canonical_circuits(layout(raw), {}).collect()
        assert [(r.feeder_id, r.geom_wkt) for r in rows] == [("u_f1", "POINT (1 2)")] * 2


@pytest.mark.parametrize("per_task", [2_000_000, 50, 3])
def test_rank_with_bins_of_any_size(spark, per_task):
    r = random.Random(3)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, r.random(), r.randrange(300) / 7])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = rank_within(df, ["k"], "v", rows_per_task=per_task)
    want = df.selectExpr("k", "v", "rank() OVER (PARTITION BY k ORDER BY v DESC NULLS LAST) AS rank")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_bin_holds_more_than_a_task_may(spark):
    """Ten million distinct values of one key, most of them close together."""
    counts = spark.range(10_000_000).selectExpr("'t' AS _k0", "CASE WHEN id % 10 = 0 THEN id * 1e6 ELSE id / 1e9 END AS _v", "1L AS _n")
    counts = counts.unionByName(spark.createDataFrame([("u", None, 1), ("u", 2.0, 1), ("t", None, 5)], "_k0 string, _v double, _n long"))
    binned, parts = cut_into_bins(counts, ["_k0"], 200_000)
    sizes = binned.groupBy(*parts).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200_000 and binned.count() == 10_000_003
    assert sizes.filter("_k0 = 'u'").count() == 1
    edges = binned.groupBy(*parts).agg(F.min("_v").alias("low"), F.max("_v").alias("high")).filter("_k0 = 't' AND low IS NOT NULL").orderBy(*parts).collect()
    assert len(edges) > 50 and all(a.low > b.high for a, b in zip(edges, edges[1:]))
