"""Remove bytes of passages that stand anywhere else in the corpus, by run-length indexes of shards of strings.

A corpus has no single index; it is dealt into shards so that equal passages meet in one. Each window of LENGTH bytes
is named by its anchor, the least hash of its runs of GRAM bytes (of equal ones the last). Consecutive windows of one
anchor are, with the bytes that they cover, a *string*; equal windows lie in strings of one anchor. Then:

1. An anchor that stands once names no repeat. Equal strings are one string with a weight; a string of weight two or
   more repeats as a whole. (In a Burrows-Wheeler transform of all copies they would only lengthen its runs.)
2. The strings of anchors with several different strings are dealt by anchor and written one after the other into
   blocks. Of each block a run-length index is built: the runs of its Burrows-Wheeler transform, with the text
   positions at the start of each run and at the end of the run before.
3. Matching statistics are streamed along the block's text: at a sampled position the longest match is compared
   anew; at every other position it is that of the position before, one byte shorter. Where a match has LENGTH bytes
   or more, its bytes are marked at both of its places.

An anchor with too many different strings for one block is refined: its windows take a second anchor under another
order of hashes, and so on, so that no task gathers a hot group and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import MULTIPLIER, mix, named_id, slices, texts_by_id
from tierstone.sources.shared import cut_lineage

#: Bytes in a window: shorter repeats stay.
LENGTH = 200
#: Bytes of a run whose hash can be an anchor: 8 times a power of two.
GRAM = 32
#: Window starts that are looked at together; a longer text is read in such pieces.
PIECE = 1 << 20
#: Text bytes of a slice: its arrays stay small enough for a processor's cache.
SLICE = 1 << 18
#: Rows that a task compares with each other before the shuffle, and different strings of one anchor from which on a
#: task deals them by string instead of by anchor.
BLOCK_ROWS, MIXED_HERE = 500_000, 64
#: Bytes of a block of the index.
BLOCK_BYTES = 1 << 20
#: Strings of one anchor that fit a block; anchors with more are refined, at most so often.
MOST_STRINGS, LEVELS = 5_000, 8

#: What a row says: these windows repeat; this string has to be compared; undecided; its anchor has several strings.
REPEATED, COMPARED, STRING, MIXED = 0, 1, 2, 3
ROWS = "deal long, key long, check long, doc long, mark int, start long, n long, source long, weight byte, kind byte"
_SCHEMA = pa.schema([
    ("deal", pa.int64()), ("key", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("mark", pa.int32()),
    ("start", pa.int64()), ("n", pa.int64()), ("source", pa.int64()), ("weight", pa.int8()), ("kind", pa.int8()),
])
_KINDS = tuple(f.type.to_pandas_dtype() for f in _SCHEMA)
Rows = tuple[np.ndarray, ...]
DEAL, KEY, CHECK, DOC, MARK, START, N, SOURCE, WEIGHT, KIND = range(10)
#: What tells documents apart: the id and a hash of the text.
OWN = ["doc", "mark"]
#: (document, its mark, place of the first byte in it, key of the level before, weight, bytes)
Piece = tuple[int, int, int, int, int, bytes]


def byte_grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of GRAM bytes."""
    if len(data) < GRAM:
        return np.empty(0, np.uint64)
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    h = mix(np.ascontiguousarray(eight).view("<u8").ravel() * MULTIPLIER)
    width = 8
    while width < GRAM:
        h = mix(h[:-width] * MULTIPLIER + h[width:])
        width *= 2
    return h


def window_anchors(grams: np.ndarray) -> np.ndarray:
    """For each window, where its anchor stands: the least of the hashes' upper 40 bits, of equal ones the last."""
    low = np.uint64((1 << 24) - 1)
    x = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    have, width = 1, LENGTH - GRAM + 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return (low - (x & low)).astype(np.int64)


def strings_of(pieces: list[Piece], level: int) -> Rows:
    """One row per string of the pieces."""
    lengths = np.array([len(p[5]) for p in pieces], np.int64)
    joined = b"".join(p[5] for p in pieces)
    if len(joined) < LENGTH:
        return _rows([])
    first = np.cumsum(lengths) - lengths
    grams = byte_grams(np.frombuffer(joined, np.uint8))
    if level:
        grams = mix(grams ^ np.uint64(level * 0x632BE59BD9B4E019 % 2**64))
    anchors = window_anchors(grams)
    owner = np.repeat(np.arange(len(pieces)), lengths)[: len(anchors)]
    starts = np.flatnonzero(np.arange(len(anchors)) + LENGTH <= (first + lengths)[owner])
    if not len(starts):
        return _rows([])
    anchors, owner = anchors[starts], owner[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    n = np.diff(np.append(np.flatnonzero(new), len(starts)))
    at, own = starts[new], owner[new]
    docs, marks, places, keys, weights = (np.array(c) for c in zip(*[p[:5] for p in pieces], strict=True))
    key = mix(grams[anchors[new]] + keys[own].astype(np.int64).view(np.uint64) * MULTIPLIER).view(np.int64)
    view = memoryview(joined)
    ends = at + n + LENGTH - 1
    check = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True)], np.uint64)
    return (
        key, key, check.view(np.int64), docs[own], marks[own].astype(np.int32), places[own] + at - first[own], n, places[own],
        weights[own].astype(np.int8), np.full(len(at), STRING, np.int8),
    )


def _rows(parts: Iterable[Rows]) -> Rows:
    columns = list(zip(*parts, strict=True)) or [[]] * len(_KINDS)
    return tuple(np.concatenate([*c, np.empty(0, k)]).astype(k, copy=False) for c, k in zip(columns, _KINDS, strict=True))


def _pick(rows: Rows, which: np.ndarray) -> Rows:
    return tuple(c[which] for c in rows)


def _with(rows: Rows, **columns: object) -> Rows:
    """The rows with whole columns replaced."""
    out = list(rows)
    for name, value in columns.items():
        i = _SCHEMA.get_field_index(name)
        out[i] = np.broadcast_to(np.asarray(value, _KINDS[i]), len(rows[0]))
    return tuple(out)


def merged(rows: Rows) -> Rows:
    """Spans of windows that follow each other in a document as one, dealt by document."""
    rows = _pick(rows, np.lexsort((rows[START], rows[MARK], rows[DOC])))
    end = rows[START] + rows[N]
    new = np.ones(len(end), bool)
    new[1:] = (rows[DOC][1:] != rows[DOC][:-1]) | (rows[MARK][1:] != rows[MARK][:-1]) | (rows[START][1:] != end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(end))[: len(first)] - 1
    rows, end = _pick(rows, first), end[last]
    return _with(rows, deal=mix(rows[DOC].view(np.uint64)).view(np.int64), key=0, check=0, n=end - rows[START], source=0, kind=REPEATED)


def settle(rows: Rows, before_shuffle: bool) -> Rows:
    """What is decided about rows that share a key, and what goes on.

    Rows of a string that stands twice repeat as a whole; one of them goes on with weight 2. After the shuffle a key
    of one string is done, and the strings of other keys are to be compared. Before it all strings go on, dealt by
    key; those of a key with very many are dealt by string, and a mark tells the key's place that there are several.
    """
    done = rows[KIND] <= COMPARED
    out = [_pick(rows, done)]
    rows = _pick(rows, ~done)
    if not len(rows[0]):
        return _rows(out)
    rows = _pick(rows, np.lexsort((rows[KIND], rows[CHECK], rows[KEY])))
    key, check, string = rows[KEY], rows[CHECK], rows[KIND] == STRING
    new_key = np.ones(len(key), bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= (check[1:] != check[:-1]) | (string[1:] != string[:-1])
    group = np.cumsum(new) - 1
    weight = np.bincount(group, np.where(string, rows[WEIGHT], 0))[group]
    # a row of weight two has been told already that it repeats
    out.append(merged(_pick(rows, string & (weight > 1) & (rows[WEIGHT] == 1))))
    first = new & string
    left = _with(_pick(rows, first), weight=np.minimum(weight[first], 2))
    own = np.cumsum(new_key) - 1
    strings = np.bincount(own, first)
    marked = np.bincount(own, ~string) > 0
    if before_shuffle:
        many = (strings >= MIXED_HERE)[own[first]]
        deal = np.where(many, mix((left[KEY] ^ left[CHECK]).view(np.uint64)).view(np.int64), left[KEY])
        # a string that is dealt apart is to be compared anyway: its weight alone is still open
        out.append(_with(left, deal=deal))
        mark = _pick(rows, new_key & ((strings >= MIXED_HERE) | marked)[own])
        out.append(_with(mark, deal=mark[KEY], check=0, kind=MIXED))
    else:
        apart = left[DEAL] != left[KEY]
        several = ((strings > 1) | marked)[own[first]] | apart
        out.append(_with(_pick(left, several), kind=COMPARED))
    return _rows(out)


def _batches(rows: Rows) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in rows], schema=_SCHEMA)


def _cut(doc: int, mark: int, data: bytes) -> Iterator[Piece]:
    for i in range(0, max(1, len(data) - LENGTH + 1), PIECE):
        yield doc, mark, i, 0, 1, data[i : i + PIECE + LENGTH - 1]


def _strings(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        """Of whole texts, or the strings that a key has had too many of."""
        for part in batches if level else slices(batches, "text", SLICE):
            for row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if level:
                    yield row
                else:
                    yield from _cut(row[0], row[1], (row[2] or "").encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[Piece] = []
        size = 0
        held: list[Rows] = []
        rows = 0
        for piece in pieces(batches):
            waiting.append(piece)
            size += len(piece[5])
            if size >= SLICE:
                held.append(strings_of(waiting, level))
                rows += len(held[-1][0])
                waiting, size = [], 0
            if rows >= BLOCK_ROWS:
                yield from _batches(settle(_rows(held), True))
                held, rows = [], 0
        held.append(strings_of(waiting, level) if waiting else _rows([]))
        yield from _batches(settle(_rows(held), True))

    return run


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles rows that come sorted by ``deal``; those of one may lie in several batches."""
    held: list[Rows] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = tuple(c.to_numpy() for c in batch.columns)
        cut = int(np.searchsorted(rows[DEAL], rows[DEAL][-1]))
        if cut or (held and held[-1][DEAL][-1] != rows[DEAL][0]):
            yield from _batches(settle(_rows([*held, _pick(rows, np.arange(cut))]), False))
            held = []
        held.append(_pick(rows, np.arange(cut, len(rows[0]))))
    if held:
        yield from _batches(settle(_rows(held), False))


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a sorted key: the first place of each value, and whether the value stands more than once."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    return head[group], (np.diff(np.append(head, len(key))) > 1)[group]


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array of a text of codes below ``symbols``, by sorting ranks of ever longer starts of the suffixes.

    The first sort takes as many symbols as fit 62 bits (0 stands for the end of the text); each further one joins
    the ranks of two or three such starts and sorts only suffixes that are still tied.
    """
    n = len(text)
    bits = symbols.bit_length()
    width = 62 // bits
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key)
    rank = np.zeros(n + 1, np.int64)  # from 1; 0 stands behind the end
    places, tied = _ranked(key[order])
    rank[order] = places + 1
    slots = np.flatnonzero(tied)
    joined = 3 if n < (1 << 20) - 1 else 2
    shift = 62 // joined
    while len(slots):
        own = order[slots]
        key = rank[own]
        for j in range(1, joined):
            key = (key << shift) | rank[np.minimum(own + j * width, n)]
        by = np.argsort(key)
        own = own[by]
        order[slots] = own
        places, tied = _ranked(key[by])
        rank[own] = slots[places] + 1
        slots = slots[tied]
        width *= joined
    return order


class RunIndex:
    """The runs of the Burrows-Wheeler transform of a block of strings, with text positions at their borders."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) + 1 for s in strings], np.int64)
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.ends = np.cumsum(lengths) - 1
        self.starts = self.ends + 1 - lengths
        # a separator is the least symbol and differs from a zero byte of the text
        seen = np.zeros(256, bool)
        plain = np.ones(len(data), bool)
        plain[self.ends] = False
        seen[data[plain]] = True
        code = (np.cumsum(seen) * seen).astype(np.uint8 if seen.sum() < 256 else np.uint16)
        text = code[data]
        text[self.ends] = 0
        order = suffix_order(text, int(seen.sum()) + 1)
        before = text[order - 1]
        # no run goes over a string's first byte, so that no match is carried over a separator
        head = np.ones(len(order), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        runs = np.flatnonzero(head)
        self.symbols, self.run_lengths = before[runs], np.diff(np.append(runs, len(order)))
        self.positions, self.neighbours = order[runs][1:], order[runs - 1][1:]
        self.data, self.text = data, text

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, other position, length) of every match of LENGTH or more that no earlier byte continues.

        These are the matching statistics of the block's text against itself: between two sampled positions the other
        end moves along and the length falls by one a byte, so the samples tell all.
        """
        a, b = self.positions, self.neighbours
        room = np.minimum(self._end(a) - a, self._end(b) - b)
        keep = room >= LENGTH
        a, b, room = a[keep], b[keep], room[keep]
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").ravel()
        length = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        at = 0
        while len(live):
            x = words[a[live] + at] ^ words[b[live] + at]
            differs = x != 0
            low = x & (~x + np.uint64(1))
            same = np.where(differs, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8, 8)
            length[live] = np.minimum(at + same, room[live])
            live = live[~differs & (at + 8 < room[live])]
            at += 8
        keep = length >= LENGTH
        return a[keep], b[keep], length[keep]

    def _end(self, at: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, at)]

    def repeated(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, first window in it, windows): spans of windows that stand twice in the block, maybe overlapping."""
        a, b, length = self.matches()
        at, windows = np.concatenate([a, b]), np.concatenate([length, length]) - LENGTH + 1
        string = np.searchsorted(self.ends, at)
        return string, at - self.starts[string], windows


FETCHED = "doc long, mark int, start long, key long, weight byte, string binary"
_FETCHED = pa.schema([
    ("doc", pa.int64()), ("mark", pa.int32()), ("start", pa.int64()), ("key", pa.int64()), ("weight", pa.int8()), ("string", pa.binary()),
])


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the strings of each document; rows of one string are in a batch."""
    for part in slices(batches, "text", SLICE):
        out: list[tuple] = []
        for doc, mark, text, spans in zip(*[c.to_pylist() for c in part.columns], strict=True):
            data = (text or "").encode()
            for s in spans:
                out.append((doc, mark, s["start"], s["key"], s["weight"], data[s["start"] : s["start"] + s["n"] + LENGTH - 1]))
                if len(out) >= 4_000:
                    yield _table(out)
                    out = []
        if out:
            yield _table(out)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FETCHED, strict=True)], schema=_FETCHED)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats within blocks of whole keys; rows come sorted by key."""
    held: list[tuple] = []
    size = 0

    def decided() -> Iterator[pa.RecordBatch]:
        string, start, n = RunIndex([h[4] for h in held]).repeated()
        docs, marks, starts = (np.array([h[i] for h in held], np.int64) for i in (1, 2, 3))
        # a span is found from both of its ends, and copies of it from each of them
        spans = np.unique(np.stack([docs[string], marks[string], starts[string] + start, n]), axis=1)
        zero = np.zeros(spans.shape[1], np.int64)
        yield from _batches(_rows([(zero, zero, zero, *spans, zero, zero, zero + REPEATED)]))

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size >= BLOCK_BYTES and held[-1][0] != row[0]:
                yield from decided()
                held, size = [], 0
            held.append(row)
            size += len(row[4]) + 1
    if held:
        yield from decided()


def _spans(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*OWN).agg(F.collect_list(F.struct(*columns)).alias("spans"))


def _found(strings: DataFrame) -> DataFrame:
    """Spans of windows that stand twice among the strings, by an index of each block of them."""
    by_key = strings.select("key", *OWN, "start", "string").repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(_indexed, ROWS).select(*OWN, "start", "n")


def repeated_spans(texts: DataFrame, most_strings: int = MOST_STRINGS, levels: int = LEVELS) -> DataFrame:
    """(doc, mark, start, n): spans of windows that stand elsewhere too, maybe overlapping.

    ``texts`` has doc, mark and text. What several steps read is stored in the shared folder: the rows of each level
    and the bytes of its strings, so that texts are fetched once however often an anchor is refined.
    """
    found = []
    source = texts
    for level in range(levels + 1):
        own = source.mapInArrow(_strings(level), ROWS).repartition("deal").sortWithinPartitions("deal")
        rows = cut_lineage(own.mapInArrow(_whole_keys, ROWS))
        found.append(rows.where(F.col("kind") == REPEATED).select(*OWN, "start", "n"))
        compared = rows.where(F.col("kind") == COMPARED)
        if level:
            parents = source.select(*OWN, F.col("start").alias("source"), F.col("string").alias("whole"))
            part = F.expr(f"substring(whole, cast(start - source + 1 as int), cast(n + {LENGTH - 1} as int))").alias("string")
            strings = compared.join(parents, [*OWN, "source"]).select(*OWN, "start", "key", "weight", part)
        else:
            with_spans = texts.join(_spans(compared, "start", "n", "key", "weight"), OWN).select(*OWN, "text", "spans")
            strings = with_spans.mapInArrow(_fetched, FETCHED)
        strings = cut_lineage(strings)
        hot = cut_lineage(compared.groupBy("key").agg(F.count("*").alias("strings")).where(F.col("strings") > most_strings))
        if level == levels or hot.isEmpty():
            found.append(_found(strings))
            break
        found.append(_found(strings.join(hot, "key", "left_anti")))
        source = strings.join(hot, "key", "left_semi").select(*OWN, "start", "key", "weight", "string")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


_RESULT = pa.schema([
    ("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()),
])
RESULT = "doc long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary"


def removed_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The maximal runs of bytes that windows of the spans cover."""
    out: list[list[int]] = []
    for start, n in sorted((s["start"], s["n"]) for s in spans or ()):
        stop = start + n + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        out = []
        for doc, text, spans in zip(*[c.to_pylist() for c in part.columns], strict=True):
            data = (text or "").encode()
            gone = removed_spans(spans)
            ends = [0, *[x for span in gone for x in span], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            out.append((doc, len(data), len(data) - len(kept), [{"start": a, "stop": b} for a, b in gone], kept))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RESULT, strict=True)], schema=_RESULT
        )


def without_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_strings: int = MOST_STRINGS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans`` (removed runs of bytes) and ``kept`` (binary).

    A byte of the UTF-8 text goes if a window of LENGTH bytes covers it that also starts at any other place, of the
    same document or another; all its copies go, the first one too. What is kept need not be valid UTF-8. Windows are
    judged on the input. A null or empty text has no bytes. Rows that repeat are copies of each other, and rows that
    share only an id are documents of their own. A null id stays null. An empty table gives no rows. Texts of any
    length are read in pieces; other columns of ``docs`` are not read.
    """
    texts = texts_by_id(docs, id_col, text_col).withColumn("mark", F.hash("text")).select(*OWN, "text")
    spans = _spans(repeated_spans(texts, most_strings), "start", "n")
    found = texts.join(spans, OWN, "left").select("doc", "text", "spans")
    cleaned = found.mapInArrow(_cleaned, RESULT)
    return cleaned.select(named_id(F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept")
