"""Files along a space-filling curve, and lookups that open few of them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierstone.sources.layout import files_within, interleaved, range_borders, range_rank, read_within, write_clustered, write_interleaved


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    r = random.Random(1)
    rows = [(r.randrange(10_000), f"s{r.randrange(500):03}", dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(365)), i) for i in range(6_000)]
    rows += [(None, None, None, -1), (7, None, dt.date(2024, 2, 1), -2)]
    df = spark.createDataFrame(rows, "a long, b string, c date, id long").repartition(4)
    path = str(tmp_path_factory.mktemp("layout") / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        write_interleaved(df, path, ["a", "b", "c"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    return path, rows


LOOKUPS = [
    {"a": (100, 160)}, {"b": ("s100", "s109")}, {"c": (dt.date(2024, 3, 1), dt.date(2024, 3, 5))}, {"b": ("s490", None), "c": (None, dt.date(2024, 1, 31))},
]


@pytest.mark.parametrize("wanted", LOOKUPS)
def test_any_column_opens_a_part_of_the_files(spark, points, wanted):
    path, rows = points
    got = read_within(spark, path, wanted)
    at = {"a": 0, "b": 1, "c": 2}

    def holds(row):
        return all(row[at[c]] is not None and (low is None or row[at[c]] >= low) and (high is None or row[at[c]] <= high) for c, (low, high) in wanted.items())

    assert sorted(r.id for r in got.collect()) == sorted(r[3] for r in rows if holds(r))
    files, all_files = files_within(spark, path, wanted), files_within(spark, path, {})
    assert len(all_files) == 64 and len(files) <= 0.55 * len(all_files)
    assert len(got.inputFiles()) == len(files)


def test_nothing_within_and_folders_without_spans(spark, points, tmp_path):
    path, rows = points
    assert read_within(spark, path, {"a": (50_000, None)}).count() == 0
    assert spark.read.parquet(path).count() == len(rows)
    write_clustered(spark.range(10).toDF("a"), str(tmp_path / "t"), ["a"])
    assert read_within(spark, str(tmp_path / "t"), {"a": (3, 4)}).count() == 2


def test_ranks_follow_the_values(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "d", "a"]], "v string")
    borders = range_borders(df, "v", ranges=4)
    got = {r.v: r.rank for r in df.select("v", range_rank(F.col("v"), borders).alias("rank")).collect()}
    assert got[None] == 0 and got["a"] <= got["b"] <= got["c"] <= got["d"] == len(borders) == 3
    assert range_borders(df.limit(0), "v") == []
    (row,) = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).collect()
    assert row.z == 0b100111
    with pytest.raises(ValueError):
        write_interleaved(df, "/nowhere", [])
