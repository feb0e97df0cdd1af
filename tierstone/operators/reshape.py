"""Rollup, unpivot, pivot."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions.cleaning import string_columns
from tierstone.functions.parsing import to_double
from tierstone.operators.skew import ROWS_PER_TASK, _null_safe, _renamed, dealt, heavy_keys
from tierstone.sources.shared import cut_lineage


def rollup_segments(
    df: DataFrame,
    keys: Sequence[str],
    mode: Mapping[str, Column] = {},
    any_value: Mapping[str, Column] = {},
    total: Mapping[str, Column] = {},
    latest: Mapping[str, Column] = {},
    earliest: Mapping[str, Column] = {},
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Many detail rows per key to one row: most common value, any value, sum, max and min.

    Output names map to input expressions.  NULLs are ignored; the mode takes the lowest value on
    ties and "any value" is the lowest one, so a rerun gives the same row.

    Rows are shuffled once, by key, and dealt over as many tasks as their number asks for; equal values of a ``mode``
    column are counted by a window on that partitioning.  A first job over the key columns finds keys above
    ``rows_per_task`` rows.  Their rows collapse to counted combinations instead, see :func:`_rolled_by_combining`, so
    neither a key with very many rows nor one with very many distinct values lands in one task as raw rows.
    """
    keys = list(keys)
    base = df.select(
        *keys,
        *[c.alias(n) for part in (mode, any_value, total, latest, earliest) for n, c in part.items()],
    )
    # max and min of text would turn the hash aggregate into a sort
    texts = set(string_columns(base))
    picks_of = {
        **{n: "mode" for n in mode},
        **{n: "min" for n in [*any_value, *[n for n in earliest if n in texts]]},
        **{n: "max" for n in latest if n in texts},
    }
    plain = {n: agg for part, agg in ((total, F.sum), (latest, F.max), (earliest, F.min)) for n in part if n not in picks_of}
    if not picks_of:
        return base.groupBy(*keys).agg(*[agg(n).alias(n) for n, agg in plain.items()])
    rows, heavy = heavy_keys(df, keys, rows_per_task)
    if heavy is None:
        return _rolled_by_sorting(base, keys, picks_of, plain, rows)
    heavy = _renamed(cut_lineage(heavy.drop("_n")), keys, "_h")
    same = _null_safe(keys, [f"_h{k}" for k in keys])
    light = _rolled_by_sorting(base.join(heavy, same, "left_anti"), keys, picks_of, plain, rows)
    return light.unionByName(_rolled_by_combining(base.join(heavy, same, "left_semi"), keys, picks_of, plain))


def _rolled_by_sorting(
    base: DataFrame, keys: list[str], picks_of: Mapping[str, str], plain: Mapping[str, Callable], rows: int
) -> DataFrame:
    """One shuffle by key; each ``mode`` column is one more sort in the same task."""
    for f in base.schema:
        if f.name in picks_of and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # grouping takes both zeros for one
            base = base.withColumn(f.name, F.col(f.name) + F.lit(0.0).cast(f.dataType))
    here = dealt(base, keys, rows)
    if here is base:
        here = base.repartition(*keys)
    picks = []
    for i, (n, how) in enumerate(picks_of.items()):
        if how == "mode":
            here = here.withColumn(f"_n{i}", F.count("*").over(Window.partitionBy(*keys, n)))
            picks.append(F.min_by(n, F.when(F.col(n).isNotNull(), F.struct(-F.col(f"_n{i}"), F.col(n)))).alias(n))
        else:
            picks.append((F.min if how == "min" else F.max)(n).alias(n))
    return here.groupBy(*keys).agg(*picks, *[agg(n).alias(n) for n, agg in plain.items()])


def _rolled_by_combining(
    base: DataFrame, keys: list[str], picks_of: Mapping[str, str], plain: Mapping[str, Callable]
) -> DataFrame:
    """The same for keys of any size.

    Rows first collapse to counted combinations of the picked columns, then each
    of these columns becomes a grouping set over the combinations, and the last step picks per
    key among counted values.  All three are aggregates with map-side partial sums, the first two
    hash aggregates.
    """
    picked = list(picks_of)
    measures = [agg(n).alias(n) for n, agg in plain.items()]
    cells = base.groupBy(*keys, *picked).agg(F.count("*").alias("_n"), *measures)
    sets = [[F.col(c) for c in keys]] + [[F.col(c) for c in [*keys, p]] for p in picked]
    counted = cells.groupingSets(sets, *[F.col(c) for c in [*keys, *picked]]).agg(
        F.grouping_id().alias("_set"), F.sum("_n").alias("_n"), *measures
    )
    # grouping_id has one bit per grouping column, set where that column is rolled up
    width = len(picked)
    whole = (1 << width) - 1

    def pick(name: str, how: str) -> Column:
        own_set = whole & ~(1 << (width - 1 - picked.index(name)))
        candidate = F.when(F.col("_set") == own_set, F.col(name))
        if how == "mode":
            order = F.when(candidate.isNotNull(), F.struct(-F.col("_n"), F.col(name)))
            return F.min_by(name, order).alias(name)
        return (F.min if how == "min" else F.max)(candidate).alias(name)

    picks = [pick(n, how) for n, how in picks_of.items()]
    picks += [F.max(F.when(F.col("_set") == whole, F.col(n))).alias(n) for n in plain]
    return counted.groupBy(*keys).agg(*picks)


def unpivot_positive(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide capacity columns to one row per (ids, column) with a positive number.

    Measures may be text; what does not parse, is NULL, not finite or not above zero is left out.
    """
    numbers = df.select(*ids, *[to_double(F.col(f"`{m}`")).alias(m) for m in measures])
    return numbers.unpivot(list(ids), list(measures), name, value).filter((F.col(value) > 0) & (F.col(value) < float("inf")))


def pivot_totals(
    category: str,
    vocabulary: Sequence[str],
    count: str,
    amount: str,
    suffixes: tuple[str, str] = ("count", "capacity_kw"),
) -> list[Column]:
    """Aggregates for a fixed-vocabulary pivot of pre-summed rows: two columns per category.

    Rows without a ``count`` are not part of the pivot.
    """
    def total(v: str, column: str) -> Column:
        other = F.when(F.col(count).isNotNull(), 0)
        return F.sum(F.when(F.col(category) == v, F.col(column)).otherwise(other))

    return [
        total(v, column).alias(f"{v.lower()}_{suffix}")
        for v in vocabulary
        for column, suffix in zip((count, amount), suffixes)
    ]
