"""Typed values out of text.  Every parse is a ``try_`` form: bad text becomes NULL, and
:func:`parse_failures` counts it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.vocab import TECHNOLOGY_SYNONYMS


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def _by_format(value: Column, tenant: Column, formats: Mapping[str, str], parse) -> Column:
    """One branch per distinct format, so the expression does not grow with the tenant count."""
    tenants_of: dict[str, list[str]] = {}
    for name, fmt in formats.items():
        tenants_of.setdefault(fmt, []).append(name)
    out = None
    for fmt, names in tenants_of.items():
        hit = tenant.isin(*names)
        out = F.when(hit, parse(value, fmt)) if out is None else out.when(hit, parse(value, fmt))
    return out


def timestamp_by_tenant(value: Column, tenant: Column, formats: Mapping[str, str]) -> Column:
    """Parse with the tenant's own pattern; NULL for a tenant without one."""
    parsed = _by_format(value, tenant, formats, lambda v, f: F.try_to_timestamp(v, F.lit(f)))
    return F.lit(None).cast("timestamp") if parsed is None else parsed


def date_by_tenant(value: Column, tenant: Column, formats: Mapping[str, str]) -> Column:
    """As :func:`timestamp_by_tenant`, for dates; the format ``"iso"`` is the default cast."""
    def parse(v: Column, fmt: str) -> Column:
        return v.try_cast("date") if fmt == "iso" else F.try_to_date(v, fmt)

    parsed = _by_format(value, tenant, formats, parse)
    return F.lit(None).cast("date") if parsed is None else parsed


def grid_codes(native_id: Column) -> dict[str, Column]:
    """``36_13_81756`` -> state 36, area 13, circuit ``81756``; all NULL unless three parts."""
    parts = F.split(native_id, "_")
    whole = F.size(parts) == 3
    return {
        "grid_state_code": F.when(whole, F.get(parts, 0).try_cast("int")),
        "grid_area_code": F.when(whole, F.get(parts, 1).try_cast("int")),
        "grid_circuit_id": F.when(whole, F.get(parts, 2)),
    }


def literal_lookup(c: Column, table: Mapping[str, str]) -> Column:
    """Look the trimmed, lower-case text up in a small fixed table; NULL if absent."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(pairs, F.lower(F.trim(c)))


def canonical_technology(c: Column, synonyms: Mapping[str, str] = TECHNOLOGY_SYNONYMS) -> Column:
    """Canonical name of a free-text technology; text without one passes through."""
    return F.coalesce(literal_lookup(c, synonyms), c)


def parse_failures(df: DataFrame, parsed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(column_name, attempted, failed) per parse: text present but no value came out.

    ``parsed`` maps a name to (text, parsed value).  One pass with map-side partial sums.
    """
    sums = []
    for name, (text, value) in parsed.items():
        sums += [
            F.count(text).alias(f"{name}__attempted"),
            F.count_if(text.isNotNull() & value.isNull()).alias(f"{name}__failed"),
        ]
    per_column = F.explode(F.array(*[
        F.struct(
            F.lit(n).alias("column_name"),
            F.col(f"{n}__attempted").alias("attempted"),
            F.col(f"{n}__failed").alias("failed"),
        )
        for n in parsed
    ]))
    return df.agg(*sums).select(per_column.alias("r")).select("r.*")
