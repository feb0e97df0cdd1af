"""Near copies by SimHash fingerprints, linked through multi-index hashing.

The 64 bits are split into five blocks. Two fingerprints that differ in at most four bits either agree in two blocks,
or agree in one and differ by one bit in each of the others. So a segment is a pair of blocks; each fingerprint is
entered into the table of each of the ten segments, and looks up, in the five segments of neighbouring blocks, the
Hamming ball of radius one around the second block (only bits that it lacks: the other of the two looks up nothing).
What meets in a table cell is compared over all 64 bits. A segment has 25 or 26 bits, so cells hold few strangers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import id_column, named_id, texts_by_id, texts_of
from tierstone.llm.components import components
from tierstone.sources.shared import cut_lineage

SHINGLE, SEED = 4, 42
#: Links join fingerprints that differ in so many bits at most; the five blocks below are made for four.
MOST_BITS = 4
#: (lowest bit, bits) of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))

_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_COLUMN = np.arange(8) * 256


def fingerprint(text: str) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    k = min(SHINGLE, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.dtype("<u8"))
    cells = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + _COLUMN
    counts = (np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _OF_BYTE).ravel()
    return int(sum(1 << b for b in np.flatnonzero(counts * 2 > len(hashes)).tolist()))


def _fingerprints(column: pa.Array) -> pa.Array:
    values = np.array([fingerprint(x) for x in texts_of(column)], np.uint64)
    return pa.array(values.view(np.int64))


def fingerprints_of(text: Column) -> Column:
    """The fingerprint of a text as a long; 0 for a null or empty one."""
    return F.arrow_udf(_fingerprints, "long")(text)


def _block(fp: Column, i: int) -> Column:
    low, bits = BLOCKS[i]
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1))


def _ball(cell: Column, flips: list[int]) -> Column:
    """The cell with one of the bits set that it lacks."""
    raised = F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda x: cell.bitwiseOR(x))
    return F.filter(raised, lambda x: x != cell)


def _cells(fp: Column) -> Column:
    """All table cells in which a fingerprint is entered or looks up others."""
    out = []
    names = {pair: i for i, pair in enumerate(combinations(range(len(BLOCKS)), 2))}
    for (i, j), name in names.items():
        width = BLOCKS[j][1]
        cell = F.shiftleft(_block(fp, i), width).bitwiseOR(_block(fp, j))
        out.append(F.array(cell.bitwiseOR(F.lit(name << 26))))
    for i in range(len(BLOCKS)):
        j = (i + 1) % len(BLOCKS)
        pair = min(i, j), max(i, j)
        width = BLOCKS[pair[1]][1]
        cell = F.shiftleft(_block(fp, pair[0]), width).bitwiseOR(_block(fp, pair[1])).bitwiseOR(F.lit(names[pair] << 26))
        flips = [1 << (b + (width if j == pair[0] else 0)) for b in range(BLOCKS[j][1])]
        out.append(_ball(cell, flips))
    return F.flatten(F.array(*out))


def _forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (member, root) of positions that connect all that small distances connect, without listing all pairs.

    The search goes breadth first from a root; each member found is tied to the root, which keeps the graph shallow.
    """
    links, left = [], np.arange(1, len(prints))
    heads = [0]
    root = 0
    while len(left):
        if not heads:
            root, left = int(left[0]), left[1:]
            heads = [root]
            continue
        head = heads.pop()
        near = np.bitwise_count(prints[left] ^ prints[head]) <= MOST_BITS
        for i in left[near].tolist():
            links.append((i, root))
            heads.append(i)
        left = left[~near]
    return links


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links out of rows (cell, fp, first) that come sorted by cell."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> pa.RecordBatch:
        cell, prints, first = rows[0], rows[1].view(np.uint64), rows[2]
        edges = np.flatnonzero(np.diff(cell)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(cell)]])
        two = starts[ends - starts == 2]
        two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= MOST_BITS]
        a, b = [first[two]], [first[two + 1]]
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            own, at = np.unique(prints[s:e], return_index=True)
            found = np.array(_forest(own), np.int64).reshape(-1, 2)
            a.append(first[s:e][at[found[:, 0]]])
            b.append(first[s:e][at[found[:, 1]]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=_LINK)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy() for c in batch.columns])
        if held and held[-1][0, -1] != rows[0, 0]:
            yield links(np.concatenate(held, axis=1))
            held = []
        cut = int(np.searchsorted(rows[0], rows[0, -1]))
        if cut:
            yield links(np.concatenate([*held, rows[:, :cut]], axis=1))
            held = []
        held.append(rows[:, cut:])
    if held:
        yield links(np.concatenate(held, axis=1))


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of the ``first`` of distinct fingerprints that connect all that differ by 4 bits or fewer.

    ``prints`` has one row per distinct fingerprint: ``fp`` and an id ``first``. Cells are dealt by number; within a
    cell, fingerprints are joined breadth first, so a cell full of near copies gives pairs in proportion to its
    size. Two of a pair differ by 4 bits or fewer, or a chain of others that do lies between them.
    """
    cells = prints.select(F.explode(_cells(F.col("fp"))).alias("cell"), "fp", "first")
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_linked, "a long, b long").distinct()


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    A component holds all documents that a chain of links of at most 4 differing bits connects; it is named by its
    smallest id. A null or empty text has fingerprint 0 and is linked like any other. A null id counts as smaller
    than any other and stays null. Rows that repeat stand as often as they came. An empty table gives no rows.
    """
    own = texts_by_id(docs, id_col, text_col).select("doc", fingerprints_of(F.col("text")).alias("fp"))
    own = cut_lineage(own)
    classes = own.groupBy("fp").agg(F.min("doc").alias("first"))
    classes = cut_lineage(classes)
    linked = components(link_fingerprints(classes), "a", "b")
    named = classes.join(linked, classes["first"] == linked["node"], "left")
    named = named.select("fp", F.coalesce("component", "first").alias("component"))
    return own.join(named, "fp").select(
        named_id(F.col("doc")).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        named_id(F.col("component")).alias("component_id"),
    )


def without_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component only; of rows that share that id, all."""
    firsts = near_copies(docs, id_col=id_col, text_col=text_col).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = firsts.select(id_column("doc_id").alias("_kept_id")).distinct()
    return docs.join(keep, id_column(id_col) == F.col("_kept_id"), "left_semi")
