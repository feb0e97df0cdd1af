"""Near copies by Jaccard similarity of word shingles, found through SimHash tables and verified.

The fingerprint of a set of shingles has a bit for each of many random directions. Two sets of similarity s differ in a
bit with chance ``acos(2s / (1 + s)) / pi``, at 0.8 about 0.15. The fingerprint is cut into segments; as in multi-index
hashing every set is entered, in the table of each segment, in the cell of its bits and the cells of the Hamming ball of
radius one around them (only bits that it lacks are set: the other of two sets has them). Two sets meet in a table if
their segments differ by one bit or none. A segment has a few bits more than it takes to number the sets, so a cell
holds few strangers however large the corpus is; and there are as many segments as give RECALL at the least similarity.

What meets is verified in two steps, by the complete distance of the fingerprints and by the sets themselves, so no pair
below the similarity is ever linked. Equal sets are one. Each member of a cell is first compared with its nearest one.
What has any other in reach of the bound is then entered again: each member is compared with the nearest one of another
component, and at last every pair that is still apart. A group of near copies thus costs in proportion to its members,
but for those that are about as similar as the bound and yet not linked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import MULTIPLIER, WordHashes, gram_hashes, id_column, mix, slices, texts_by_id, texts_of
from tierstone.llm.components import components
from tierstone.sources.shared import cut_lineage

#: Words of a shingle; texts of at least this similarity, in hundredths, are near copies.
WORDS, LEAST_PERCENT = 5, 80
#: Share of the pairs at the least similarity that meet in some table (of more similar pairs, more).
RECALL = 0.96
#: Bits that a segment has beyond those that number the sets, and its least number of bits.
SPARE_BITS, LEAST_BITS = 2, 20
#: Standard deviations above the expected distance up to which pairs are verified.
SPREAD = 2.5
#: 64-bit words of a fingerprint at least: the more, the better its complete distance tells the similarity.
LEAST_WORDS = 12
#: Shingles whose bits are held at once; members of a cell that are compared at once.
BLOCK, NEAR = 4_096, 2_000


class Tables:
    """Segments and distances for a number of sets and a least similarity."""

    def __init__(self, sets: int, least_percent: int = LEAST_PERCENT, recall: float = RECALL):
        s = least_percent / 100
        self.differ = math.acos(2 * s / (1 + s)) / math.pi
        self.bits = max(LEAST_BITS, math.ceil(math.log2(max(sets, 1))) + SPARE_BITS)
        meet = (1 - self.differ) ** self.bits + self.bits * self.differ * (1 - self.differ) ** (self.bits - 1)
        self.segments = 1 if meet >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))
        self.words = max(LEAST_WORDS, -(-self.segments * self.bits // 64))

    def most(self, bits: int) -> int:
        """The distance of so many bits that pairs at the least similarity seldom exceed."""
        return math.floor(bits * self.differ + SPREAD * math.sqrt(bits * self.differ * (1 - self.differ)))


def shingles(text: str, words: WordHashes, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, in order; a shorter text is one run, one without words has none."""
    own = words.of(text.encode().lower().split())
    return np.unique(gram_hashes(own, min(size, len(own)))) if len(own) else np.empty(0, np.uint64)


def fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` times 64 bits; a bit is 1 if it is set in over half of the shingles' bits."""
    counts = np.zeros(words * 64, np.int64)
    steps = np.arange(1, words + 1, dtype=np.uint64) * MULTIPLIER
    for at in range(0, len(hashes), BLOCK):
        drawn = mix(hashes[at : at + BLOCK, None] + steps)
        counts += np.unpackbits(drawn.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)


def cells_of(print_: np.ndarray, tables: Tables) -> np.ndarray:
    """The cells that a fingerprint is entered in: of each segment its own and those with one more bit."""
    bits = np.unpackbits(print_.view(np.uint8), bitorder="little")[: tables.segments * tables.bits].reshape(tables.segments, -1)
    powers = np.uint64(1) << np.arange(tables.bits, dtype=np.uint64)
    own = bits.astype(np.uint64) @ powers
    segment, lacking = np.nonzero(bits == 0)
    ball = own[segment] | powers[lacking]
    names = np.arange(tables.segments, dtype=np.uint64) << np.uint64(tables.bits)
    return np.concatenate([own | names, ball | names[segment]])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of hashes have at least this Jaccard similarity; two empty ones have."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


DIGEST = "doc long, high long, low long, n long"
_DIGEST = pa.schema([("doc", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("n", pa.int64())])
PRINT = "doc long, high long, low long, n long, print array<long>"


def _long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def sketches(texts: DataFrame, size: int, words: int) -> DataFrame:
    """(doc, high, low, n, print): a digest of the set of shingles, how many it has, and its fingerprint."""
    schema = pa.schema([*_DIGEST, ("print", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in slices(batches, "text"):
            sets = [shingles(x, hashes, size) for x in texts_of(part.column(1))]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            prints = pa.array([fingerprint(s, words).view(np.int64) for s in sets], pa.list_(pa.int64()))
            n = pa.array([len(s) for s in sets], pa.int64())
            high, low = _long([d >> 64 for d in digests]), _long([d % 2**64 for d in digests])
            yield pa.RecordBatch.from_arrays([part.column(0), high, low, n, prints], schema=schema)

    return texts.mapInArrow(run, PRINT)


def table_cells(classes: DataFrame, tables: Tables) -> DataFrame:
    """(cell, first, part): the cells of each class, with the last 64 bits of its fingerprint."""
    schema = pa.schema([("cell", pa.int64()), ("first", pa.int64()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                prints = np.array(rows.column(1).to_pylist(), np.int64).view(np.uint64)
                cells = [cells_of(p, tables) for p in prints]
                lengths = [len(c) for c in cells]
                first = np.repeat(rows.column(0).to_numpy(), lengths)
                part = np.repeat(prints[:, -1].view(np.int64), lengths)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(cells).view(np.int64), first, part)], schema=schema)

    return classes.select("first", "print").mapInArrow(run, "cell long, first long, part long")


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Columns (cell, first, ...) of some rows.
Cell = tuple[np.ndarray, ...]
#: Whether rows are near each other (side by side, or with a new axis all with all); inf: never.
Apart = Callable[[Cell, Cell], np.ndarray]
FAR = 1 << 20


def _by_cell(apart: Apart, most: int, every: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of members of a cell, at most ``most`` apart, out of rows that come sorted by cell, in the first column.

    Each member with its nearest one, or (``every``) with all. Of a very large cell each block is looked through alone
    for nearest ones; a member that has none there is paired with itself, so that it stays in question.
    """
    def of_large(cell: Cell) -> Iterator[np.ndarray]:
        first, n = cell[1], len(cell[1])
        step = max(1, NEAR * 50 // n) if every else NEAR
        for at in range(0, n, step):
            own = tuple(c[at : at + step, None] for c in cell)
            other = tuple(c[None, :] if every else c[None, at : at + step] for c in cell)
            distance = apart(own, other)
            if every:
                a, b = np.nonzero(distance <= most)
                yield np.stack([first[at + a], first[b]], axis=1)
                continue
            np.fill_diagonal(distance, FAR)
            best = distance.argmin(1)
            near = distance[np.arange(len(best)), best] <= most
            here = first[at : at + step]
            yield np.stack([here[near], here[best[near]]], axis=1)
            if n > NEAR:
                yield np.stack([here[~near]] * 2, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Cell] = []

        def pairs() -> Iterator[pa.RecordBatch]:
            rows = tuple(np.concatenate(c) for c in zip(*held, strict=True))
            edges = np.flatnonzero(np.diff(rows[0])) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(rows[0])]])
            two = starts[ends - starts == 2]
            a, b = tuple(c[two] for c in rows), tuple(c[two + 1] for c in rows)
            near = apart(a, b) <= most
            found = [np.stack([a[1][near], b[1][near]], axis=1)]
            for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
                found += of_large(tuple(c[s:e] for c in rows))
            both = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            if len(both):
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=_PAIR)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(
                np.stack(c.to_pylist()).astype(np.int64) if pa.types.is_list(c.type) else c.to_numpy() for c in batch.columns
            )
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut or (held and held[-1][0][-1] != rows[0][0]):
                held.append(tuple(c[:cut] for c in rows))
                yield from pairs()
                held, rows = [], tuple(c[cut:] for c in rows)
            held.append(rows)
        if held:
            yield from pairs()

    return run


def _parts_apart(x: Cell, y: Cell) -> np.ndarray:
    """Of rows (cell, first, 64 bits): by these bits."""
    return np.bitwise_count(x[2].view(np.uint64) ^ y[2].view(np.uint64)).astype(np.int32)


def _prints_apart(x: Cell, y: Cell) -> np.ndarray:
    """Of rows (cell, first, component, fingerprint): by all bits; rows of one component have nothing to find out."""
    a, b = x[3].view(np.uint64), y[3].view(np.uint64)
    distance = np.zeros(np.broadcast_shapes(x[1].shape, y[1].shape), np.int32)
    for i in range(a.shape[-1]):
        distance += np.bitwise_count(a[..., i] ^ b[..., i])
    distance[np.broadcast_to(x[2] == y[2], distance.shape)] = FAR
    return distance


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of documents whose sets are similar; stored. Only the texts of pairs are read again."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in slices(batches, "text"):
            found = pa.array([shingles(x, hashes, size).tobytes() for x in texts_of(part.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), found], names=["doc", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            kept = [
                (a, b) for a, b, x, y in zip(*columns, strict=True)
                if similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
            ]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept, strict=True)], schema=_PAIR)

    ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    own = cut_lineage(texts.join(ids, "doc", "left_semi").mapInArrow(sets, "doc long, own binary"))
    a, b = (own.select(F.col("doc").alias(x), F.col("own").alias(f"{x}_own")) for x in ("a", "b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "a_own", "b_own")
    return cut_lineage(both.mapInArrow(run, "a long, b long").distinct())


def similar_links(texts: DataFrame, words: int = WORDS, least_percent: int = LEAST_PERCENT, recall: float = RECALL) -> DataFrame:
    """Links (a, b) whose components are those of all similar pairs that meet in a table; ``texts`` has doc and text."""
    # the count decides the tables: of rows, which is at least that of sets
    tables = Tables(texts.count(), least_percent, recall)
    own = cut_lineage(sketches(texts, words, tables.words))
    classes = cut_lineage(own.groupBy("high", "low").agg(F.min("doc").alias("first"), F.min("n").alias("n"), F.min("print").alias("print")))
    same = own.join(classes.select("high", "low", "first"), ["high", "low"]).select(F.col("first").alias("a"), F.col("doc").alias("b"))
    complete = tables.most(64 * tables.words)
    prints = classes.select("first", "n", "print")

    def met(cells: DataFrame, apart: Apart, most: int, every: bool = False) -> DataFrame:
        by_cell = cells.repartition("cell").sortWithinPartitions("cell")
        return cut_lineage(by_cell.mapInArrow(_by_cell(apart, most, every), "a long, b long").distinct())

    def in_reach(pairs: DataFrame) -> DataFrame:
        """The pairs whose complete fingerprints leave them a chance, with the sizes of their sets."""
        a, b = (prints.select(F.col("first").alias(x), F.col("n").alias(f"{x}_n"), F.col("print").alias(f"{x}_print")) for x in ("a", "b"))
        close = _distance(F.col("a_print"), F.col("b_print")) <= complete
        return pairs.join(a, "a").join(b, "b").where(close).select("a", "b", "a_n", "b_n")

    def linked(pairs: DataFrame) -> DataFrame:
        sized = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * least_percent
        return verified(pairs.where("a <> b").where(sized).select("a", "b"), texts, words, least_percent)

    tried = cut_lineage(in_reach(met(table_cells(classes.where("n > 0"), tables), _parts_apart, tables.most(64))))
    links = cut_lineage(linked(tried).union(same.where("a <> b")).distinct())
    again = tried.select(F.col("a").alias("first")).union(tried.select("b")).distinct()
    again = cut_lineage(table_cells(classes.join(again, "first", "left_semi"), tables).drop("part"))
    for every in (False, True):
        joined = cut_lineage(components(links, "a", "b"))
        placed = prints.join(joined, prints["first"] == joined["node"], "left").select("first", F.coalesce("component", "first").alias("component"), "print")
        cells = again.join(placed, "first").select("cell", "first", "component", "print")
        # what had no other near it in its block of a very large cell is paired with itself, which is no news
        pairs = met(cells, _prints_apart, complete, every).where("a <> b").join(tried, ["a", "b"], "left_anti")
        more = cut_lineage(in_reach(pairs))
        links = cut_lineage(links.union(linked(more)).distinct())
        tried = tried.union(more)
    return links


def without_near_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least_percent: int = LEAST_PERCENT,
    recall: float = RECALL,
) -> DataFrame:
    """``docs`` with the row of the smallest id of each component of similar texts only; of rows that share that id, all.

    Two texts are linked if the sets of their runs of ``words`` words have a Jaccard similarity of ``least_percent``
    hundredths or more; words are separated by ASCII white space, ASCII letters count as small ones, and a text of
    fewer words is one run. Texts without words are equal. A null id counts as smaller than any other. Rows that share
    an id are one node, linked to what any of them is linked to. Of pairs at the bound a share of ``recall`` is found.
    """
    texts = texts_by_id(docs, id_col, text_col)
    links = similar_links(texts, words, least_percent, recall)
    gone = components(links, "a", "b").where("node <> component").select(F.col("node").alias("_gone_id"))
    return docs.join(gone, id_column(id_col) == F.col("_gone_id"), "left_anti")
