"""Null markers, column names and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.vocab import NULL_SENTINELS, RAW_TRACKING_COLUMNS

BOM = "\ufeff"


def trim_whitespace(c: Column) -> Column:
    """Strip every kind of leading and trailing whitespace (``trim`` alone only knows the space).

    The characters are those of the regular expression ``\\s``; a byte scan is much cheaper.
    """
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def sentinel_to_null(c: Column) -> Column:
    """NULL for a null marker, otherwise the trimmed text."""
    trimmed = trim_whitespace(c)
    return F.when(~trimmed.isin(*NULL_SENTINELS), trimmed)


def blank_to_null(c: Column) -> Column:
    """NULL for blanks and any casing of ``NULL``; other text is left untrimmed."""
    shown = F.trim(c)
    return F.when((shown != "") & (F.upper(shown) != "NULL"), c)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_null_sentinels(
    df: DataFrame, columns: Iterable[str] | None = None, policy: str = "sentinels"
) -> DataFrame:
    """Turn null markers into NULL in one projection.

    ``columns=None`` means every string column, an empty list means none, absent names are
    skipped.  ``policy`` is ``"sentinels"`` or ``"blank_or_null"``.
    """
    rule = {"sentinels": sentinel_to_null, "blank_or_null": blank_to_null}[policy]
    wanted = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: rule(F.col(f"`{c}`")) for c in wanted}) if wanted else df


def strip_utf8_bom(df: DataFrame) -> DataFrame:
    """Drop a byte-order mark from the start of column names; values are untouched."""
    names = [c.replace(BOM, "") if c.startswith(BOM) else c for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def drop_raw_tracking_columns(df: DataFrame) -> DataFrame:
    return df.drop(*RAW_TRACKING_COLUMNS)


def tenant_key(tenant: Column, *parts: Column) -> Column:
    """``tenant_part_part...``; NULL as soon as one part is NULL, i.e. an unresolved key."""
    pieces = [tenant]
    for part in parts:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def optional_column(df: DataFrame, name: str | None, dtype: str = "string") -> Column:
    """The named column (in any casing) if the frame has it, else a typed NULL."""
    present = name is not None and name.lower() in (c.lower() for c in df.columns)
    return F.col(f"`{name}`") if present else typed_null(dtype)
