"""CSV drops whose headers differ: every file is read with its own header, all columns as text."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.context import RunContext
from tierstone.functions.cleaning import BOM
from tierstone.functions.lineage import add_lineage
from tierstone.functions.rescued import object_or_null, recover_rescued
from tierstone.sources.heads import file_heads
from tierstone.vocab import CASE_VARIANTS

# The delivered CSV dialect.
DIALECT = {"header": True, "quote": '"', "escape": '"', "multiLine": False}
RESCUED = "_rescued_data"
#: Columns the pipeline adds itself; a delivered column of such a name goes to the rescued data.
RESERVED = (
    RESCUED, "_index_col_dropped", "ingestion_timestamp", "ingestion_date", "pipeline_update_id", "source_file",
    "file_signature", "batch_id", "utility_id",
)
#: Key in the rescued data for the text of a row with more cells than the header.
LONG_ROW = "_long_row"


def tenant_glob(landing: str, dataset: str) -> str:
    return f"{landing.rstrip('/')}/*/{dataset}"


def literal(path: str) -> str:
    """A path that a reader takes as it is, whatever glob characters its name has."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def plain_path(path: Column) -> Column:
    """A file's name as it was given: metadata columns show it URL-encoded, with three slashes if it is local."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:///")


def scanned_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, header): the first line of each file that is not blank, by a text scan of the whole files.

    For stores that only Spark's own readers reach.  Only the first block of each file can hold the header.
    """
    lines = spark.read.text([literal(p) for p in paths]).where(F.col("value").rlike(r"[^\x00-\x20]")).select(
        "value",
        plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = F.min_by("value", "line").alias("header")
    return lines.filter("block_start = 0").groupBy("file_path").agg(first)


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Distinct header line -> files.  Bounded by the files of one batch, which are listed on the
    driver anyway.

    One CSV scan over files with different headers would map them by position, so headers come first.  A file is
    opened for its first block only, however long it is; what cannot be opened so is scanned.
    """
    groups: dict[str, list[str]] = {}
    left = []
    # a listing may name a file twice
    for row in file_heads(spark, list(dict.fromkeys(paths))).collect():
        if row.error is not None:
            left.append(row.path)
        elif row.header is not None:
            groups.setdefault(row.header, []).append(row.path)
    if left:
        for row in scanned_headers(spark, left).collect():
            groups.setdefault(row.header, []).append(row.file_path)
    return groups


def header_cells(header: str) -> list[str]:
    """Column names of a header line; an empty cell at position i is ``_ci``, a repeated name gets
    its position as suffix."""
    cells = next(csv.reader([header.removeprefix(BOM)]))
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell.strip().removeprefix(BOM) or f"_c{i}"
        names.append(f"{name}_{i}" if name in names else name)
    return names


def new_column_names(headers: Iterable[str], known: Sequence[str]) -> list[str]:
    """Named columns no known or reserved column equals in any casing, in order of appearance."""
    taken = {k.lower() for k in [*known, *RESERVED]}
    added = []
    for header in sorted(headers):
        for i, name in enumerate(header_cells(header)):
            if name != f"_c{i}" and name.lower() not in taken:
                taken.add(name.lower())
                added.append(name)
    return added


def _read_group(spark: SparkSession, header: str, paths: list[str], known: Sequence[str]) -> DataFrame:
    names = header_cells(header)
    positional = [f"_p{i}" for i in range(len(names))]
    text = T.StringType()
    schema = T.StructType([T.StructField(p, text) for p in [*positional, "_line"]])
    rows = spark.read.options(**DIALECT, columnNameOfCorruptRecord="_line").schema(schema).csv([literal(p) for p in paths])
    at = dict(zip(names, positional))
    path = plain_path(F.col("_metadata.file_path"))
    strays = [F.struct(F.lit(n).alias("key"), F.col(p).alias("value")) for n, p in at.items() if n not in known]
    # a row of another length comes with its text; it is longer if it has a cell behind the last column
    wider = ", ".join(f"{p} string" for p in [*positional, "_behind", "_line"])
    behind = F.from_csv("_line", F.lit(wider), {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_line"})
    longer = F.when(F.col("_line").isNotNull() & behind["_behind"].isNotNull(), F.col("_line"))
    strays.append(F.struct(F.lit(LONG_ROW).alias("key"), longer.alias("value")))
    present = F.filter(F.array(*strays), lambda s: s["value"].isNotNull())
    with_path = F.concat(present, F.array(F.struct(F.lit("_file_path").alias("key"), path.alias("value"))))
    rescued = F.when(F.size(present) > 0, object_or_null(F.map_from_entries(with_path)))
    return rows.select(
        *[(F.col(at[k]) if k in at else F.lit(None).cast("string")).alias(k) for k in known],
        rescued.alias(RESCUED),
        path.alias("_path"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_modification_time").alias("_modified"),
    )


def read_drops(
    spark: SparkSession,
    groups: dict[str, list[str]],
    known: Sequence[str],
    run: RunContext,
    case_variants: dict[str, str] = CASE_VARIANTS,
) -> DataFrame:
    """Rows of all files as text columns ``known``, with lineage and rescued data.

    Columns outside ``known`` (matched case-exactly) go to ``_rescued_data``, and so do reserved
    names and, under LONG_ROW, rows with more cells than the header; casing variants come
    back into their column and pure artifacts are cleared.  To let new columns in, pass ``known``
    extended by :func:`new_column_names`.
    """
    parts = [_read_group(spark, header, paths, known) for header, paths in sorted(groups.items())]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    rows = recover_rescued(rows, RESCUED, variants=case_variants)
    return add_lineage(rows, run, F.col("_path"), F.col("_size"), F.col("_modified")).drop("_path", "_size", "_modified")
