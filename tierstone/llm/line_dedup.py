"""Remove lines that equal, or nearly equal, an earlier line of the corpus: a segment-partition edit join.

Equal lines of any length are found by their hashes. Two lines within EDITS edits, of which one is cut into EDITS + 1 segments, share one of these segments: that many
edits cannot touch them all. So each distinct line is entered under its own segments (with its length and the number
of the segment), and looks up, for its own length and the EDITS lengths below it, those of its substrings that can
be the segment if the edits left and right of it are to add up. What meets under a segment is compared with a banded
bit-parallel edit distance.

Texts stay where they are until then: segments travel as hashes, only lines that share one with another line are
fetched, and pairs are compared, counted and dropped inside a group, never listed.

Lines of one template all meet under the segments they have in common. Such a cell is refined: what a line holds beside
the shared segment is within EDITS edits again, so it is cut into EDITS + 1 parts, too, at places that share out evenly
what the cell's lines differ in, and lines meet only if one of these parts is equal as well.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import id_column, named_id, slices, texts_by_id, texts_of
from tierstone.sources.shared import cut_lineage

#: Lines this near to an earlier one go.
EDITS = 2
#: Lines of fewer characters (without blanks at the ends) are compared for equality only: two edits make another line of
#: a short one. Empty lines stay.
LEAST_CHARS = 20
#: Lines whose places a task compares with each other before the shuffle.
BLOCK_LINES = 150_000

#: Pairs of entered and asking lines from which on a cell is refined; position blocks by which its lines are compared,
#: and hashed values of a block that are told apart.
MOST_PAIRS = 100_000
BLOCKS, SYMBOLS = 256, 64

ENTERED, ASKED = 0, 1


def compared_lines(text: str) -> list[tuple[int, str]]:
    """(number, line without blanks at its ends) of the lines that are compared: all but empty ones."""
    return [(i, y) for i, x in enumerate(text.split("\n")) if (y := x.strip())]


@lru_cache(20_000)
def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(first character, characters) of each of edits + 1 segments of nearly one size."""
    size, longer = divmod(length, edits + 1)
    sizes = [size] * (edits + 1 - longer) + [size + 1] * longer
    firsts = [sum(sizes[:i]) for i in range(edits + 1)]
    return list(zip(firsts, sizes, strict=True))


@lru_cache(60_000)
def looked_up(length: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, first character, characters) of the substrings of a line that can be a segment of a shorter one."""
    return _windows(segments(other, edits), length, length - other, edits)


def _windows(parts: list[tuple[int, int]], length: int, more: int, edits: int) -> list[tuple[int, int, int]]:
    out = []
    for i, (at, size) in enumerate(parts):
        low = max(at - i, at + more - (edits - i), 0)
        high = min(at + i, at + more + (edits - i), length - size)
        out += [(i, x, size) for x in range(low, high + 1)]
    return out


@lru_cache(20_000)
def rest_parts(length: int, cuts: tuple[int, ...]) -> list[tuple[int, int]]:
    """(first character, characters) of the parts of a rest, what stands beside a segment, cut at these places."""
    firsts, ends = (0, *cuts), (*cuts, length)
    return [(x, y - x) for x, y in zip(firsts, ends, strict=True)]


@lru_cache(60_000)
def rest_looks(length: int, other: int, cuts: tuple[int, ...], edits: int) -> list[tuple[int, int, int]]:
    """Like ``looked_up``, for rests: the shorter one is cut at these places."""
    return _windows(rest_parts(other, cuts), length, length - other, edits)


def rest_cell(number: int, part: int, piece: str) -> int:
    """The cell inside a refined one in which lines meet whose rests share this part."""
    return xxhash.xxh64_intdigest(piece.encode(), (number + part + 1) % 2**64)


def cell(length: int, segment: int, piece: str) -> int:
    return xxhash.xxh64_intdigest(piece.encode(), seed=length * 16 + segment)


def cells(line: str, edits: int) -> tuple[list[int], list[int]]:
    """Hashes of the cells in which a line is entered, and of those in which it looks."""
    n = len(line)
    digest = xxhash.xxh64_intdigest
    own = [digest(line[a : a + k].encode(), n * 16 + i) for i, (a, k) in enumerate(segments(n, edits))]
    looks = {digest(line[a : a + k].encode(), seed) for seed, a, k in _looks(n, edits)}
    return own, list(looks)


@lru_cache(20_000)
def _looks(length: int, edits: int) -> list[tuple[int, int, int]]:
    """(seed of the cell, first character, characters) of all that a line of this length looks for."""
    lengths = range(max(length - edits, edits + 1), length + 1)
    return [(m * 16 + i, a, k) for m in lengths for i, a, k in looked_up(length, m, edits)]


def within(a: str, b: str, edits: int) -> bool:
    """Whether two texts are within so many edits: common ends are cut off, the rest goes through a banded bit vector.

    Bit k of column j stands for row j - edits + k, so the band moves down by one row with each column. D0 tells where
    a diagonal step costs nothing; the distance is summed up along the diagonal of the last cell.
    """
    if len(a) < len(b):
        a, b = b, a
    more = len(a) - len(b)
    if more > edits:
        return False
    start = 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) <= edits:
        return True
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        places[c] |= 1 << i
    band = (1 << (2 * edits + 1)) - 1
    rising, falling = band & ~((1 << (edits + 1)) - 1), (1 << (edits + 1)) - 1
    distance = more
    for j, c in enumerate(b, 1):
        shift = j - edits - 1
        rising, falling = rising >> 1 | 1 << (2 * edits), falling >> 1
        here = (places.get(c, 0) >> shift if shift >= 0 else places.get(c, 0) << -shift) & band
        free = ((((here & rising) + rising) ^ rising) | here | falling) & band
        right_up = (falling | ~(free | rising)) & band
        right_down = free & rising
        distance += not free >> (edits + more) & 1
        if distance > edits + more:
            return False
        right_up, right_down = (right_up << 1 | 1) & band, (right_down << 1) & band
        rising, falling = (right_down | ~(free | right_up)) & band, right_up & free
    return distance <= edits


PLACES = "key long, check long, doc long, line int, first boolean"
_PLACE = pa.schema([
    ("key", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("line", pa.int32()), ("first", pa.bool_()),
])
Places = tuple[np.ndarray, ...]


def _earliest(places: Places) -> Places:
    """Places ordered by line, with ``first`` where a place is the earliest of its line; a place counts once."""
    key, check, doc, line, first = places
    order = np.lexsort((line, doc, check, key))
    key, check, doc, line, first = (c[order] for c in (key, check, doc, line, first))
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (check[1:] == check[:-1])
    twice = same.copy()
    twice[1:] &= (doc[1:] == doc[:-1]) & (line[1:] == line[:-1])
    return tuple(c[~twice] for c in (key, check, doc, line, ~same & first | ~same))


def _place_batches(places: Places) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(places[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 200_000]) for c in places], schema=_PLACE)


def _line_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of all compared lines; a place that is not the first of its line in the block is settled already."""
    rows: list[tuple[int, int, int, int]] = []

    def block() -> Iterator[pa.RecordBatch]:
        if rows:
            table = np.array([r[:2] for r in rows], np.uint64).view(np.int64)
            doc, line = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int32)
            yield from _place_batches(_earliest((table[:, 0], table[:, 1], doc, line, np.ones(len(rows), bool))))

    for part in slices(batches, "text"):
        for doc, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
            for i, line in compared_lines(text):
                raw = line.encode()
                rows.append((xxhash.xxh64_intdigest(raw), xxhash.xxh64_intdigest(raw, 1), doc, i))
        if len(rows) >= BLOCK_LINES:
            yield from block()
            rows.clear()
    yield from block()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by their first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (held and held[-1].column(0)[-1].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches):
        yield from _place_batches(_earliest(tuple(c.to_numpy() for c in table.columns)))


def line_places(texts: DataFrame) -> DataFrame:
    """All places of compared lines, with ``first`` for the earliest of each distinct line; stored."""
    places = texts.mapInArrow(_line_places, PLACES)
    open_, settled = places.where("first"), places.where("not first")
    placed = open_.repartition("key").sortWithinPartitions("key").mapInArrow(_first_places, PLACES)
    return cut_lineage(placed.unionByName(settled))


_CELL = pa.schema([("cell", pa.int64()), ("key", pa.int64()), ("role", pa.int8())])
CELLS = "cell long, key long, role byte"


def _line_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for part in slices(batches, "text"):
        out, keys, sizes = [], [], []
        for text in texts_of(part.column(1)):
            for _, line in compared_lines(text):
                if len(line) < LEAST_CHARS:
                    continue
                key = xxhash.xxh64_intdigest(line.encode())
                if key in seen:
                    continue
                seen.add(key)
                own, looks = cells(line, EDITS)
                out += own
                out += looks
                keys.append(key)
                sizes.append((len(own), len(looks)))
        if keys:
            size = np.array(sizes)
            role = np.repeat(np.tile(np.array([ENTERED, ASKED], np.int8), len(keys)), size.ravel())
            key = np.repeat(np.array(keys, np.uint64).view(np.int64), size.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, np.uint64).view(np.int64)), pa.array(key), pa.array(role)], schema=_CELL)
        if len(seen) > BLOCK_LINES:
            seen.clear()


_SHARED = pa.schema([*_CELL, ("hot", pa.bool_())])
SHARED = CELLS + ", hot boolean"


def _shared_cells(batches: Iterator[pa.RecordBatch], most_pairs: int) -> Iterator[pa.RecordBatch]:
    """Rows of the cells in which a line looks and a different one is entered; each once. Cells of many pairs are hot."""
    for table in _groups(batches):
        place, key, role = (c.to_numpy() for c in table.columns)
        order = np.lexsort((role, key, place))
        place, key, role = place[order], key[order], role[order]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (role[1:] != role[:-1])
        place, key, role = place[new], key[new], role[new]
        start = np.ones(len(place), bool)
        start[1:] = place[1:] != place[:-1]
        group = np.cumsum(start) - 1
        low, high = np.minimum.reduceat(key, np.flatnonzero(start)), np.maximum.reduceat(key, np.flatnonzero(start))
        pairs = np.bincount(group, role == ENTERED) * np.bincount(group, role == ASKED)
        keep = ((low != high) & (pairs > 0))[group]
        if keep.any():
            hot = (pairs > most_pairs)[group]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (place, key, role, hot)], schema=_SHARED)


def shared_cells(texts: DataFrame, most_pairs: int) -> DataFrame:
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shared_cells(batches, most_pairs)

    rows = texts.mapInArrow(_line_cells, CELLS)
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(shared, SHARED)


def _own_cells(line: str) -> dict[int, tuple[int, int, int]]:
    """Number of each cell in which a line is entered (as a signed long) -> (segment, first character, characters)."""
    n = len(line)
    return {_signed(cell(n, i, line[a : a + k])): (i, a, k) for i, (a, k) in enumerate(segments(n, EDITS))}


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


_SYMBOL = pa.schema([("cell", pa.int64()), ("length", pa.int32()), ("block", pa.int32()), ("symbol", pa.int32()), ("n", pa.int64())])
SYMBOL_ROWS = "cell long, length int, block int, symbol int, n long"


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each block of the rests of a hot cell's entered lines has each hashed value."""
    for part in slices(batches, "text"):
        found: Counter[tuple[int, int, int, int]] = Counter()
        for text, asked in zip(texts_of(part.column(1)), part.column(2).to_pylist(), strict=True):
            lines = dict(compared_lines(text))
            for x in asked:
                line = lines.get(x["line"])
                where = _own_cells(line).get(x["cell"]) if line else None
                if where:
                    rest = line[: where[1]] + line[sum(where[1:]) :]
                    size = -(-len(rest) // BLOCKS)
                    for i in range(0, len(rest), size):
                        found[x["cell"], len(rest), i // size, xxhash.xxh32_intdigest(rest[i : i + size].encode()) % SYMBOLS] += 1
        if found:
            rows = ((*key, n) for key, n in found.items())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SYMBOL, strict=True)], schema=_SYMBOL)


def cut_places(length: int, spread: list[float], edits: int = EDITS) -> list[int]:
    """Places that cut a rest into edits + 1 parts, none empty, of like sums of the spread of its blocks."""
    size = -(-length // BLOCKS)
    sums = np.cumsum(np.maximum(spread, 0) + 1e-6)
    out = []
    for i in range(1, edits + 1):
        place = (int(np.searchsorted(sums, sums[-1] * i / (edits + 1))) + 1) * size
        out.append(min(max(place, (out[-1] if out else 0) + 1), length - edits - 1 + i))
    return out


def hot_cuts(texts: DataFrame, hot: DataFrame) -> DataFrame:
    """(cell, cuts): where the rests of a hot cell's lines are cut; their spread is the entropy of what stands in a block."""
    def places(length: pa.Array, spread: pa.Array) -> pa.Array:
        rows = zip(length.to_pylist(), spread.to_pylist(), strict=True)
        return pa.array([cut_places(n, [x["spread"] for x in xs]) for n, xs in rows], pa.list_(pa.int32()))

    by_doc = hot.where(F.col("role") == ENTERED).groupBy("doc").agg(F.collect_set(F.struct("line", "cell")).alias("asked"))
    counts = texts.join(by_doc, "doc").select("doc", "text", "asked").mapInArrow(_symbols, SYMBOL_ROWS)
    counts = counts.groupBy("cell", "length", "block", "symbol").agg(F.sum("n").alias("n"))
    spread = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
    blocks = counts.groupBy("cell", "length", "block").agg(spread.alias("spread"))
    cells_ = blocks.groupBy("cell").agg(F.min("length").alias("length"), F.sort_array(F.collect_list(F.struct("block", "spread"))).alias("spread"))
    return cells_.select("cell", F.arrow_udf(places, "array<int>")("length", "spread").alias("cuts"))


_FETCHED = pa.schema([
    ("cell", pa.int64()), ("role", pa.int8()), ("doc", pa.int64()), ("line", pa.int32()), ("text", pa.string()),
    ("cuts", pa.list_(pa.list_(pa.int32()))),
])
FETCHED = "cell long, role byte, doc long, line int, text string, cuts array<array<int>>"


def _asked_inside(line: str, wanted: dict[int, tuple[int, ...]]) -> set[int]:
    """Cells inside refined ones in which a line looks."""
    out = set()
    n = len(line)
    for other in range(max(n - EDITS, EDITS + 1), n + 1):
        for i, a, k in looked_up(n, other, EDITS):
            number = cell(other, i, line[a : a + k])
            cuts = wanted.get(_signed(number))
            if cuts is not None:
                rest = line[:a] + line[a + k :]
                out |= {rest_cell(number, j, rest[b : b + m]) for j, b, m in rest_looks(n - k, other - k, cuts, EDITS)}
    return out


def _line_rows(doc: int, number: int, line: str, asked: list[dict]) -> Iterator[tuple]:
    """The rows of a line in all its cells; a refined cell gives rows of the cells inside it.

    Entered lines carry the cuts of their refined cells, by segment, so that a pair's first cell can be told anywhere.
    """
    entered = [x for x in asked if x["role"] == ENTERED]
    looks = [x for x in asked if x["role"] == ASKED]
    hot = {x["cell"]: tuple(x["cuts"]) for x in entered if x["cuts"] is not None}
    cuts = None
    if hot:
        own = _own_cells(line)
        cuts = [list(hot.get(c, ())) for c in own]
        for c, (_, a, k) in own.items():
            if c in hot:
                rest = line[:a] + line[a + k :]
                for j, (b, m) in enumerate(rest_parts(len(rest), hot[c])):
                    yield _signed(rest_cell(c % 2**64, j, rest[b : b + m])), ENTERED, doc, number, line, cuts
    yield from ((x["cell"], ENTERED, doc, number, line, cuts) for x in entered if x["cuts"] is None)
    yield from ((x["cell"], ASKED, doc, number, line, None) for x in looks if x["cuts"] is None)
    wanted = {x["cell"]: tuple(x["cuts"]) for x in looks if x["cuts"] is not None}
    if wanted:
        yield from ((_signed(c), ASKED, doc, number, line, None) for c in _asked_inside(line, wanted))


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines asked for, with their texts."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FETCHED, strict=True)], schema=_FETCHED)

    for part in slices(batches, "text"):
        rows: list[tuple] = []
        for doc, text, asked in zip(part.column(0).to_pylist(), texts_of(part.column(1)), part.column(2).to_pylist(), strict=True):
            lines = dict(compared_lines(text))
            by_line: dict[int, list] = defaultdict(list)
            for x in asked:
                by_line[x["line"]].append(x)
            for number, own in by_line.items():
                if number in lines:
                    rows += _line_rows(doc, number, lines[number], own)
            if len(rows) > 50_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


def first_cell(text: str, other: str, cuts: list[list[int]] | None, edits: int) -> int | None:
    """The first cell in which a line meets an entered one that is not longer, in an order that both sides know."""
    pieces = segments(len(other), edits)
    for i, a, k in looked_up(len(text), len(other), edits):
        at = pieces[i][0]
        if text[a : a + k] != other[at : at + k]:
            continue
        number = cell(len(other), i, text[a : a + k])
        if not cuts or not cuts[i]:
            return number
        rest, other_rest, places = text[:a] + text[a + k :], other[:at] + other[at + k :], tuple(cuts[i])
        parts = rest_parts(len(other_rest), places)
        for j, b, m in rest_looks(len(rest), len(other_rest), places, edits):
            if rest[b : b + m] == other_rest[parts[j][0] : parts[j][0] + m]:
                return rest_cell(number, j, rest[b : b + m])
    return None


def links_in_cell(number: int, entered: list[tuple], asked: list[tuple], edits: int) -> dict[tuple[int, int], list]:
    """(doc, line) -> [links, earliest linked place] for links that this cell, of all that hold the pair, is first to show.

    Members are (doc, line, text, cuts). A line is compared with shorter ones, and with later ones of its own length.
    """
    out: dict[tuple[int, int], list] = {}
    for doc, line, text, _ in asked:
        for other_doc, other_line, other, cuts in entered:
            more = len(text) - len(other)
            if not 0 <= more <= edits or text == other or (more == 0 and (other_doc, other_line) > (doc, line)):
                continue
            if first_cell(text, other, cuts, edits) == number and within(text, other, edits):
                for own, linked in (((doc, line), (other_doc, other_line)), ((other_doc, other_line), (doc, line))):
                    found = out.setdefault(own, [0, linked])
                    found[0] += 1
                    found[1] = min(found[1], linked)
    return out


_LINKS = pa.schema([
    ("doc", pa.int64()), ("line", pa.int32()), ("links", pa.int64()), ("other_doc", pa.int64()), ("other_line", pa.int32()),
])
LINKS = "doc long, line int, links long, other_doc long, other_line int"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches):
        groups: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        for number, role, *member in zip(*(c.to_pylist() for c in table.columns), strict=True):
            groups[number][role].append(member)
        rows = [
            (*place, n, *other)
            for number, (entered, asked) in groups.items()
            for place, (n, other) in links_in_cell(number % 2**64, entered, asked, EDITS).items()
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LINKS, strict=True)], schema=_LINKS)


def line_links(texts: DataFrame, places: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(doc, line, links, earlier) of distinct lines, at their first places: links to other lines, is one earlier.

    Cells of more than ``most_pairs`` pairs are refined; that changes the work and not the links.
    """
    asked = shared_cells(texts, most_pairs).join(places.where("first").select("key", "doc", "line"), "key")
    asked = cut_lineage(asked.select("doc", "line", "cell", "role", "hot"))
    hot = asked.where("hot").drop("hot")
    asked = asked.where("not hot").drop("hot").withColumn("cuts", F.lit(None).cast("array<int>"))
    if not hot.isEmpty():
        asked = asked.unionByName(hot.join(cut_lineage(hot_cuts(texts, hot)), "cell"))
    by_doc = asked.groupBy("doc").agg(F.collect_set(F.struct("line", "cell", "role", "cuts")).alias("asked"))
    fetched = texts.join(by_doc, "doc").select("doc", "text", "asked").mapInArrow(_fetched, FETCHED)
    found = fetched.repartition("cell").sortWithinPartitions("cell").mapInArrow(_verified, LINKS)
    own, other = F.struct("doc", "line"), F.struct(F.col("other_doc").alias("doc"), F.col("other_line").alias("line"))
    return found.withColumn("earlier", other < own).groupBy("doc", "line").agg(
        F.sum("links").alias("links"), F.max("earlier").alias("earlier")
    )


_RESULT = pa.schema([
    ("doc", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("n_links", pa.int64()), ("text", pa.string()),
])
RESULT = "doc long, n_lines long, n_removed long, n_links long, text string"


def without_lines(text: str, gone: Iterable[int]) -> str:
    gone = set(gone)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows = []
        for doc, text, gone, links in zip(*(c.to_pylist() for c in part.columns), strict=True):
            kept = text if text is None or not gone else without_lines(text, gone)
            rows.append((doc, len(compared_lines(text or "")), len(set(gone or [])), links or 0, kept))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)


def line_decisions(texts: DataFrame) -> DataFrame:
    """(doc, gone, links): numbers of the lines to remove, and links of the lines that first stand there."""
    places = line_places(texts)
    links = line_links(texts, places)
    rows = places.where("not first").select("doc", "line", F.lit(True).alias("gone"), F.lit(0).cast("long").alias("links"))
    rows = rows.union(links.select("doc", "line", "earlier", "links"))
    return rows.groupBy("doc").agg(F.collect_list(F.when(F.col("gone"), F.col("line"))).alias("gone"), F.sum("links").alias("links"))


def without_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines`` compared, ``n_removed``, ``n_links``, ``text`` without them.

    A line that is not empty goes if an equal one stands earlier, and one of at least LEAST_CHARS characters also if
    another of that length within EDITS edits does: in a document with a smaller id or further up in the same one. ``n_links`` counts, for the distinct lines that
    first stand in the document, the other distinct lines they are linked to. A null text stays null, an empty one
    empty. Rows that share an id are one document for this and lose the same lines. A null id is smaller than any
    other and stays null. An empty table gives no rows. Extra columns play no part.
    """
    texts = texts_by_id(docs, id_col, text_col)
    found = texts.join(line_decisions(texts), "doc", "left").select("doc", "text", "gone", "links")
    cleaned = found.mapInArrow(_cleaned, RESULT)
    return cleaned.select(named_id(F.col("doc")).alias("doc_id"), "n_lines", "n_removed", "n_links", "text")


def _without_gone(texts: pa.Array, gone: pa.Array) -> pa.Array:
    pairs = zip(texts.to_pylist(), gone.to_pylist(), strict=True)
    return pa.array([t if t is None or not g else without_lines(t, g) for t, g in pairs], pa.string())


def clean_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts of ``without_repeated_lines`` and all other columns as they are."""
    decided = line_decisions(texts_by_id(docs, id_col, text_col)).select(F.col("doc").alias("_line_doc"), F.col("gone").alias("_line_gone"))
    found = docs.withColumn("_line_doc", id_column(id_col)).join(decided, "_line_doc", "left")
    cleaned = F.arrow_udf(_without_gone, "string")(F.col(text_col).cast("string"), F.col("_line_gone"))
    return found.withColumn(text_col, cleaned).select(*[F.col(f"`{c}`") for c in docs.columns])
