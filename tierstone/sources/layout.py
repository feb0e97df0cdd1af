"""Clustered layouts: rows lie so that lookups open few files, along one column or along several at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.sources.csv_drops import literal, plain_path
from tierstone.sources.shared import cut_lineage

#: Each column is cut into so many ranges, a power of two; their borders come from a sample of so many values.
RANGES, SAMPLED = 256, 50_000
#: Beside the files, where readers do not look: what each file spans.
SPANS = "_spans"


def _hashable(kind: T.DataType) -> bool:
    """Maps cannot be hashed, nor anything that holds one."""
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``by``.

    A hash of the row is the last range column: a value with very many rows is cut over several
    partitions instead of filling one.
    """
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)])
    return df.repartitionByRange(*[F.col(c) for c in by], spread).sortWithinPartitions(*by)


def write_clustered(df: DataFrame, path: str, by: Sequence[str]) -> None:
    clustered(df, by).write.mode("overwrite").parquet(path)


def range_borders(df: DataFrame, column: str, ranges: int = RANGES, sampled: int = SAMPLED) -> list:
    """Up to ``ranges - 1`` borders that cut the column's values into ranges of about equal size, whatever their type.

    They come from a sample of bounded size: a border decides where rows lie and nothing else.
    """
    values = df.select(column).filter(F.col(column).isNotNull())
    share = min(1.0, sampled / max(1, values.count()))
    found = sorted(r[0] for r in values.sample(share, seed=7).limit(2 * sampled).collect())
    return [found[len(found) * i // ranges] for i in range(1, ranges)] if found else []


def range_rank(column: Column, borders: list) -> Column:
    """How many of the sorted borders are not above the value, by binary search; 0 for NULL."""
    if not borders:
        return F.lit(0)
    points, steps, step = F.array(*[F.lit(b) for b in borders]), [], 1 << (len(borders).bit_length() - 1)
    while step:
        steps.append(F.lit(step))
        step //= 2
    return F.aggregate(F.array(*steps), F.lit(0), lambda low, s: low + F.when(F.get(points, low + s - 1) <= column, s).otherwise(0))


def with_ranks(df: DataFrame, borders: Mapping[str, tuple[str, list]]) -> DataFrame:
    """Add range ranks as columns (name -> column, borders), a step of all the binary searches at a time.

    The same numbers as :func:`range_rank`, for many rows: each step is one comparison of compiled code.
    """
    at = {n: 0 for n in borders}
    for step in (1 << b for b in reversed(range(max((len(p).bit_length() for _, p in borders.values()), default=0)))):
        moved = {}
        for n, (c, points) in borders.items():
            if step <= len(points):
                low = F.col(n) if at[n] else F.lit(0)
                above = F.get(F.array(*[F.lit(b) for b in points]), low + (step - 1)) <= F.col(f"`{c}`")
                moved[n], at[n] = low + F.when(above, step).otherwise(0), 1
        df = df.withColumns(moved)
    return df.withColumns({n: F.lit(0) for n, found in at.items() if not found})


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number out of the bits of several, the highest bits of all first: near in it is near in each of them."""
    parts = [
        F.shiftleft(F.shiftright(rank.cast("long"), b).bitwiseAND(F.lit(1)), b * len(ranks) + len(ranks) - 1 - i)
        for b in range(bits) for i, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_interleaved(df: DataFrame, path: str, by: Sequence[str], ranges: int = RANGES) -> None:
    """Write the rows along a space-filling curve of up to seven columns, with the spans of each file.

    The ranks of a row's values among the ranges of their columns are interleaved bit by bit, so every file spans a
    small box and a lookup on any of the columns opens a part of the files. A value that fills many ranges is cut by
    a hash of the row. The rows are computed once and stored, as borders and ranges read them first.
    """
    if not 1 <= len(by) <= 7:
        raise ValueError("one to seven columns")
    rows = cut_lineage(df)
    bits = (ranges - 1).bit_length()
    ranks = {f"_rank{i}": (c, range_borders(rows, c, ranges)) for i, c in enumerate(by)}
    curve = interleaved([F.col(n) for n in ranks], bits)
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema if _hashable(f.dataType)])
    placed = with_ranks(rows, ranks).withColumn("_at", curve).drop(*ranks).repartitionByRange("_at", spread).sortWithinPartitions("_at", *by)
    placed.drop("_at").write.mode("overwrite").parquet(path)
    write_spans(df.sparkSession, path, by)


def write_spans(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """One row per file of a folder: its name, its rows, the least and greatest value and the NULLs of some columns."""
    name = F.regexp_extract(plain_path(F.col("_path")), r"([^/]*)$", 1)
    # the name is cut out of the path once per file, and not of every row
    found = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("_path")).agg(
        F.count("*").alias("n"), *[F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c in columns]
    )
    found = found.select(name.alias("file"), *[c for c in found.columns if c != "_path"])
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/{SPANS}")


def files_within(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> list[str] | None:
    """Files that can hold a row whose columns lie in ``wanted`` (column -> least and greatest value, None: unbounded).

    None if the folder has no spans. Only the small table of spans is read.
    """
    try:
        spans = spark.read.parquet(f"{path}/{SPANS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    for column, (low, high) in wanted.items():
        if column in spans.columns:
            if low is not None:
                spans = spans.filter(F.col(f"{column}.high") >= F.lit(low))
            if high is not None:
                spans = spans.filter(F.col(f"{column}.low") <= F.lit(high))
    return [f"{path}/{r.file}" for r in spans.orderBy("file").collect()]


def read_within(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """Rows whose columns lie in ``wanted``; files that cannot hold any are neither listed nor opened."""
    files = files_within(spark, path, wanted)
    whole = spark.read.parquet(path)
    rows = whole if files is None else spark.read.schema(whole.schema).parquet(*[literal(f) for f in files]) if files else whole.limit(0)
    for column, (low, high) in wanted.items():
        if low is not None:
            rows = rows.filter(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.filter(F.col(column) <= F.lit(high))
    return rows
