"""Ordered work on keys of any size.

``Window.partitionBy(key)`` puts all rows of a key into one task.  The helpers here find the few
keys that are too big for that, cut only those keys into ordered segments, and pass values over
segment borders through a summary of one row per segment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.sources.shared import cut_lineage

ROWS_PER_TASK = 2_000_000
MAX_HOT_KEYS = 1_000
# segments per hot key; powers of two, because segments are found by binary search
MAX_CUTS = 4_096
# of a hot key's texts, so many are sorted for each cut
TEXTS_PER_CUT = 20
# rows that one task sorts where the number of tasks is set by :func:`dealt`
ROWS_PER_SORT = 500_000
# hash buckets whose rows are counted to see whether any key can be heavy
KEY_BUCKETS = 65_536

SEGMENT = "_segment"


def dealt(df: DataFrame, keys: Sequence[str], rows: int, rows_per_task: int = ROWS_PER_SORT) -> DataFrame:
    """``df``, of about ``rows`` rows, hash-partitioned by ``keys`` so that a task gets about ``rows_per_task`` of them.

    Adaptive execution makes few large tasks out of a shuffle that compresses well; the number set here is kept, so that
    a task's memory does not grow with the table. Where every core would get less than that, ``df`` stays as it is.
    """
    tasks = -(-rows // rows_per_task)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[int, DataFrame | None]:
    """How many rows there are, and (keys, ``_n``) of the keys with more than ``rows_per_task`` (None: there are none).

    Rows are counted per hash bucket, so the usual answer costs a pass over the key columns and next to no shuffle; keys
    are counted only in buckets that are full enough to hold a heavy one.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    counted = df.groupBy(bucket.alias("_b")).agg(F.count("*").alias("_n"))
    full = F.collect_list(F.when(F.col("_n") > rows_per_task, F.col("_b")))
    rows, suspects = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)), full).first()
    if not suspects:
        return rows, None
    suspected = df.filter(bucket.isin(suspects)) if len(suspects) <= MAX_HOT_KEYS else df
    return rows, suspected.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task)


def cut_points(at: Column, cuts: int) -> Column:
    """Aggregate: ``cuts - 1`` approximate quantiles of ``at``."""
    return F.percentile_approx(at, [i / cuts for i in range(1, cuts)], 20 * cuts)


def segment_of(points: Column, at: Column, cuts: int) -> Column:
    """How many of the sorted ``points`` are not above ``at``, by binary search."""
    steps = []
    step = cuts // 2
    while step:
        steps.append(F.lit(step))
        step //= 2
    return F.aggregate(
        F.array(*steps), F.lit(0), lambda lo, step: lo + F.when(F.get(points, lo + step - 1) <= at, step).otherwise(0)
    )


def position(df: DataFrame, order: str) -> Column | None:
    """A value that never decreases along ``order`` and can be cut: a number, or the text itself; None for other types."""
    dtype, c = df.schema[order].dataType, F.col(order)
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_date(c.cast("date")) * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60 + F.second(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    return None


def _is_text(df: DataFrame, order: str) -> bool:
    return isinstance(df.schema[order].dataType, T.StringType)


def _points_of(df: DataFrame, keys: Sequence[str], order: str, names: DataFrame, cuts: int) -> DataFrame:
    """(keys, ``_points``): cut points of each of the keys in ``names`` (keys, ``_n``) along ``order``.

    Numbers have approximate quantiles. Texts have none, so about ``TEXTS_PER_CUT * cuts`` of a key's rows, picked by a
    hash, stand for all: sorted, they give the points. A point decides in which segment a row is worked on, and the
    result does not depend on it.
    """
    if not _is_text(df, order):
        at = position(df, order).cast("double")
        picked = df.select(*keys, at.alias("_at")).join(names.drop("_n"), list(keys))
        return picked.groupBy(*keys).agg(cut_points(F.col("_at"), cuts).alias("_points"))
    share = F.lit(TEXTS_PER_CUT * cuts) / F.col("_n")
    drawn = F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.col(order), F.rand(11)), F.lit(1_000_000)) / 1_000_000
    picked = df.select(*keys, order).filter(F.col(order).isNotNull()).join(names, list(keys)).filter(drawn < share)
    held = picked.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("_held"))
    return held.select(*keys, F.transform(
        F.sequence(F.lit(1), F.lit(cuts - 1)), lambda i: F.get("_held", F.floor(F.size("_held") * i / cuts).cast("int"))
    ).alias("_points"))


@dataclass(frozen=True)
class HotKeys:
    """A frame of the hot keys; ``_points`` holds ``cuts - 1`` cut points of each.

    Up to MAX_HOT_KEYS of them are a ``small`` local frame that is broadcast; more are stored and joined.
    """

    frame: DataFrame
    cuts: int
    small: bool = True

    def side(self, *columns: str) -> DataFrame:
        """The frame, or some of its columns, as the right side of a join."""
        frame = self.frame.select(*columns) if columns else self.frame
        return F.broadcast(frame) if self.small else frame


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], order: str, rows_per_task: int = ROWS_PER_TASK
) -> HotKeys | None:
    """Keys with more than ``rows_per_task`` rows, each with cut points along ``order``.

    None if there are none, which is the usual case and leaves the plan free of any skew handling.
    Finding out takes one job over the key columns (:func:`heavy_keys`), naming the hot keys and measuring them two more.  Up to
    ``MAX_HOT_KEYS`` rows come to the driver and are broadcast; if there are more, the hot keys stay a
    stored frame and are joined, with their large sides left, which adaptive execution can split.
    Keys and cut points are fixed from here on, so a task that is run again after a lost executor
    gets the same segments.
    """
    if position(df, order) is None:
        return None
    _, heavy = heavy_keys(df, keys, rows_per_task)
    if heavy is None:
        return None
    found = heavy.orderBy(F.desc("_n"), *keys).limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return None
    small = len(found) <= MAX_HOT_KEYS
    cuts = 2
    while cuts < MAX_CUTS and cuts * rows_per_task < found[0]["_n"]:
        cuts *= 2
    names = F.broadcast(df.sparkSession.createDataFrame(found, heavy.schema)) if small else cut_lineage(heavy)
    measured = _points_of(df, keys, order, names, cuts)
    if not small:
        return HotKeys(cut_lineage(measured), cuts, small=False)
    return HotKeys(df.sparkSession.createDataFrame(measured.collect(), measured.schema), cuts)


def without_hot_keys(df: DataFrame, hot: HotKeys, keys: Sequence[str]) -> DataFrame:
    return df.join(hot.side(*keys), list(keys), "left_anti")


def only_hot_keys(df: DataFrame, hot: HotKeys, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of the hot keys, with an ordered segment number in ``_segment``."""
    at = position(df, order) if _is_text(df, order) else position(df, order).cast("double")
    return (
        df.join(hot.side(), list(keys))
        .withColumn(SEGMENT, segment_of(F.col("_points"), at, hot.cuts))
        .drop("_points")
    )


def _parts(df: DataFrame, keys: Sequence[str]) -> tuple[list[str], bool]:
    segmented = SEGMENT in df.columns
    return [*keys, SEGMENT] if segmented else list(keys), segmented


def with_neighbours(df: DataFrame, keys: Sequence[str], order: str, value: Column) -> DataFrame:
    """Add ``_prev`` and ``_next``: ``value`` (never NULL) of the rows before and after in the key.

    Rows with a ``_segment`` are windowed per segment, so no task sees a whole key; at a segment
    border the neighbour comes from an aggregate of one row per segment.
    """
    parts, segmented = _parts(df, keys)
    w = Window.partitionBy(*parts).orderBy(order)
    near = df.withColumns({"_prev": F.lag(value).over(w), "_next": F.lead(value).over(w)})
    if not segmented:
        return near
    along = Window.partitionBy(*keys).orderBy(SEGMENT)
    ends = df.groupBy(*parts).agg(F.min_by(value, order).alias("_first"), F.max_by(value, order).alias("_last"))
    borders = ends.select(*parts, F.lag("_last").over(along).alias("_before"), F.lead("_first").over(along).alias("_after"))
    return (
        near.join(borders, parts)
        .withColumns({"_prev": F.coalesce("_prev", "_before"), "_next": F.coalesce("_next", "_after")})
        .drop("_before", "_after")
    )


def with_next_two(df: DataFrame, keys: Sequence[str], order: str, value: Column) -> DataFrame:
    """Add ``_n1`` and ``_n2``: ``value`` (never NULL) of the next row and the one after it."""
    parts, segmented = _parts(df, keys)
    w = Window.partitionBy(*parts).orderBy(order)
    ahead = df.withColumns({"_n1": F.lead(value, 1).over(w), "_n2": F.lead(value, 2).over(w)})
    if not segmented:
        return ahead
    along = Window.partitionBy(*keys).orderBy(SEGMENT)
    firsts = (
        df.withColumns({"_v": value, "_v2": F.lead(value).over(w), "_before": F.lag(order).over(w)})
        .filter("_before IS NULL")
        .select(*parts, "_v", "_v2")
    )
    # a segment with one row continues in the segment after it
    borders = firsts.select(
        *parts,
        F.lead("_v").over(along).alias("_a1"),
        F.coalesce(F.lead("_v2").over(along), F.lead("_v", 2).over(along)).alias("_a2"),
    )
    beyond = F.when(F.col("_n1").isNotNull(), F.col("_a1")).otherwise(F.col("_a2"))
    return (
        ahead.join(borders, parts)
        .withColumns({"_n1": F.coalesce("_n1", "_a1"), "_n2": F.coalesce(F.col("_n2"), beyond)})
        .drop("_a1", "_a2")
    )


def _null_safe(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def _value_counts(df: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, list[str]]:
    """Rows per distinct value, under own names: one frame is on both sides of later joins."""
    ks = [f"_k{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, ks)], F.col(value).alias("_v"))
    return grouped.agg(F.count("*").alias("_n")), ks


def _running_before(count: str, w: WindowSpec) -> Column:
    """Sum of ``count`` over the rows before this one."""
    return F.coalesce(F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def top_within(df: DataFrame, keys: Sequence[str], value: str, k: int, name: str = "rank") -> DataFrame:
    """Rows whose competition rank by ``value`` (highest first, NULL last) is at most ``k``.

    The ``k`` highest distinct values of a key hold all such rows.  Finding them is a top-k window
    over value counts, which the optimizer already limits before the shuffle, so neither a big key
    nor a value shared by very many rows meets in one task.
    """
    counts, ks = _value_counts(df, keys, value)
    w = Window.partitionBy(*ks).orderBy(F.desc_nulls_last("_v"))
    highest = counts.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= k)
    ranked = highest.select(*ks, "_v", (_running_before("_n", w) + 1).alias(name)).filter(F.col(name) <= k)
    return df.join(ranked, _null_safe([*keys, value], [*ks, "_v"])).select(*df.columns, name)


def rank_within(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Competition rank of ``value`` (highest first, NULL last) within ``keys``.

    Equal to ``rank() over (partition by keys order by value desc nulls last)`` without sorting a
    key in one task: equal values collapse to a count before the shuffle, distinct values are
    ranked inside value bins, and bins are offset by the running count of the bins above.  How many bins there are
    follows from the counts: a key with more than ``rows_per_task`` distinct values is cut, and so is each of its bins
    that is still too large.  The counts and the bins are stored, so that every use sees the same ones.
    """
    counts, ks = _value_counts(df, keys, value)
    binned, parts = cut_into_bins(cut_lineage(counts), ks, rows_per_task)
    by_value = Window.partitionBy(*parts).orderBy(F.desc_nulls_last("_v"))
    inside = binned.withColumn("_inside", _running_before("_n", by_value))
    if len(parts) == len(ks):
        ranked = inside.select(*ks, "_v", (F.col("_inside") + 1).alias(name))
    else:
        bins = binned.groupBy(*parts).agg(F.sum("_n").alias("_bin_n"))
        above = _running_before("_bin_n", Window.partitionBy(*ks).orderBy(*parts[len(ks):]))
        offsets = _renamed(bins.select(*parts, above.alias("_above")), parts, "o")
        ranked = inside.join(offsets, _null_safe(parts, [f"o{p}" for p in parts])).select(
            *ks, "_v", (F.col("_above") + F.col("_inside") + 1).alias(name)
        )
    return df.join(ranked, _null_safe([*keys, value], [*ks, "_v"]), "left").select(*df.columns, name)


def _renamed(frame: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return frame.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def cut_into_bins(counts: DataFrame, ks: list[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, list[str]]:
    """Distinct values ``_v`` per key with columns that number their bins from the highest values down, NULL last.

    Every round cuts what still holds more than ``rows_per_task`` values, at quantiles of its own; a value stands in
    one bin, so a round that cuts nothing further would be the last, but distinct values can always be told apart.
    """
    parts = list(ks)
    while True:
        sizes = counts.groupBy(*parts).agg(F.count("*").alias("_size"))
        largest = sizes.agg(F.max("_size")).first()[0] or 0
        if largest <= rows_per_task:
            return counts, parts
        cuts = 2
        # twice as many as needed, as the quantiles are approximate
        while cuts < MAX_CUTS and cuts * rows_per_task < 2 * largest:
            cuts *= 2
        large = _renamed(sizes.filter(F.col("_size") > rows_per_task).drop("_size"), parts, "s")
        same = _null_safe(parts, [f"s{p}" for p in parts])
        borders = cut_lineage(
            counts.join(large, same).groupBy(*[f"s{p}" for p in parts]).agg(cut_points(F.col("_v"), cuts).alias("_points"))
        )
        at = F.when(F.col("_points").isNull(), 0).when(F.col("_v").isNull(), cuts).otherwise(
            cuts - 1 - segment_of(F.col("_points"), F.col("_v"), cuts)
        )
        bin_name = f"_bin{len(parts) - len(ks)}"
        counts = cut_lineage(
            counts.join(borders, same, "left").withColumn(bin_name, at).drop("_points", *[f"s{p}" for p in parts])
        )
        parts = [*parts, bin_name]
