"""Values that did not fit the known schema, kept as one JSON object per row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.vocab import CASE_VARIANTS, RESCUED_ARTIFACTS


def pack_rescued(values: Mapping[str, Column]) -> Column:
    """JSON object of the non-NULL values; NULL when there are none."""
    if not values:
        return F.lit(None).cast("string")
    full = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
    return object_or_null(F.map_filter(full, lambda _, v: v.isNotNull()))


def rescued_map(rescued: Column) -> Column:
    return F.from_json(rescued, "map<string,string>")


def object_or_null(m: Column) -> Column:
    """JSON text of a map, with NULL for an empty one."""
    return F.when(F.size(m) > 0, F.to_json(m))


def recover_rescued(
    df: DataFrame,
    column: str = "_rescued_data",
    variants: Mapping[str, str] = CASE_VARIANTS,
    artifacts: Iterable[str] = RESCUED_ARTIFACTS,
    flag: str = "_index_col_dropped",
) -> DataFrame:
    """Move casing variants back into their columns and clear rescued data that is only artifact.

    The JSON is parsed once into a map.  Each ``variants`` key whose target exists fills the
    target where that is NULL and leaves the object.  If only ``artifacts`` keys remain the
    object becomes NULL and ``flag`` is true; real drift is kept as it is.  ``flag`` is always
    true or false, and text that is not a JSON object is never thrown away.
    """
    if column not in df.columns:
        return df.withColumn(flag, F.lit(False))
    moved = {k: t for k, t in variants.items() if t in df.columns}
    artifact_keys = list(artifacts)
    raw, parsed = F.col(column), F.col("_rescued_map")

    def keep_known_out(k: Column, _: Column) -> Column:
        return ~k.isin(*moved) if moved else F.lit(True)

    rest = F.map_filter(parsed, keep_known_out)
    business = F.map_filter(parsed, lambda k, _: ~k.isin(*moved, *artifact_keys))
    only_artifacts = F.coalesce((F.size(rest) > 0) & (F.size(business) == 0), F.lit(False))
    return (
        df.withColumn("_rescued_map", rescued_map(raw))
        .withColumns({t: F.coalesce(F.col(t), F.try_element_at(parsed, F.lit(k))) for k, t in moved.items()})
        .withColumns({
            flag: only_artifacts,
            column: F.when(parsed.isNull(), raw).when(~only_artifacts, object_or_null(rest)),
        })
        .drop("_rescued_map")
    )
