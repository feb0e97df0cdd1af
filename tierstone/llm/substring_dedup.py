"""Remove passages that occur earlier in the corpus: seed, extend, keep maximal repeats.

Seeds are winnowed anchors. Each window of LENGTH words takes the least hash of its runs of SEED words (of equal
ones the last) as its anchor, so equal windows have the same anchor at the same place, and about one word in eight
is an anchor. The windows of one anchor follow each other; with the words that they cover they are its *stretch*.
Windows can only be equal if their anchors are, so documents are joined on anchors, in three steps:

1. Anchors that occur once are dropped. Equal stretches are equal as a whole, so all but the earliest repeat it.
2. Where an anchor stands in several different stretches, the match ends somewhere inside them. Only for the earliest
   copy of each of these stretches the single windows are compared, which extends matches both ways word by word.
3. All windows that repeat an earlier one are merged per document; their union are the maximal repeats.

Nothing is compared in pairs: a step keeps the earliest of equal items, so a passage in very many documents costs
one row per copy, and a task keeps the earliest of what it has read before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import WordHashes, gram_hashes, named_id, range_hashes, slices, texts_by_id, texts_of
from tierstone.sources.shared import cut_lineage

#: Words in a window: shorter repeats stay.
LENGTH = 20
#: Words in an anchor.
SEED = 6
#: Rows that a task compares with each other before the shuffle.
BLOCK_ROWS = 1_500_000

REPEATED, UNSETTLED, STRETCH, MIXED = 0, 1, 2, 3
ROWS = "key long, check long, doc long, start int, n int, kind byte"
_SCHEMA = pa.schema([
    ("key", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("n", pa.int32()),
    ("kind", pa.int8()),
])
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def last_least(x: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, where the least one is; of equal ones the last."""
    at = np.arange(len(x))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(x[right] <= x[left], right, left)
        have += step
    return at


def stretches(hashes: list[np.ndarray], docs: np.ndarray) -> Rows:
    """One row per anchor of each document: anchor, hash of the stretch, document, first window, windows, kind."""
    lengths = np.array([len(h) for h in hashes], np.int64)
    h = np.concatenate([*hashes, np.empty(0, np.uint64)])
    if len(h) < LENGTH:
        return _rows([])
    first = np.cumsum(lengths) - lengths
    grams = gram_hashes(h, SEED)
    anchor = last_least(grams, LENGTH - SEED + 1)
    owner = np.repeat(np.arange(len(hashes)), lengths)[: len(anchor)]
    inside = np.arange(len(anchor)) + LENGTH <= (first + lengths)[owner]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return _rows([])
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[starts][1:] != anchor[starts][:-1]) | (owner[starts][1:] != owner[starts][:-1])
    s = starts[new]
    n = np.diff(np.append(np.flatnonzero(new), len(starts)))
    check = range_hashes(h, s, s + n + LENGTH - 1)
    own = owner[s]
    return (
        grams[anchor[s]].view(np.int64), check.view(np.int64), docs[own], (s - first[own]).astype(np.int32),
        n.astype(np.int32), np.full(len(s), STRETCH, np.int8),
    )


def windows(hashes: np.ndarray, doc: int, spans: list[tuple[int, int]]) -> Rows:
    """One row per window of the given spans (first window, windows) of one document."""
    at = np.unique(np.concatenate([np.arange(s, s + n) for s, n in spans]))
    at = at[at + LENGTH <= len(hashes)]
    if not len(at):
        return _rows([])
    key = gram_hashes(hashes, LENGTH)[at]
    check = range_hashes(hashes, at, at + LENGTH)
    one = np.ones(len(at), np.int32)
    return key.view(np.int64), check.view(np.int64), np.full(len(at), doc), at.astype(np.int32), one, one.astype(np.int8) * STRETCH


def _rows(parts: Iterable[Rows]) -> Rows:
    columns = list(zip(*parts, strict=True)) or [[]] * 6
    kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int8)
    return tuple(np.concatenate([*c, np.empty(0, k)]).astype(k) for c, k in zip(columns, kinds, strict=True))


def _pick(rows: Rows, which: np.ndarray) -> Rows:
    return tuple(c[which] for c in rows)


def merged(rows: Rows, kind: int) -> Rows:
    """Spans of the same document that touch or overlap become one; rows are dealt by document."""
    _, _, doc, start, n, _ = rows
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start.astype(np.int64) + n)[order]
    if not len(doc):
        return rows
    new_doc = np.ones(len(doc), bool)
    new_doc[1:] = doc[1:] != doc[:-1]
    group = np.cumsum(new_doc)
    reach = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    new = new_doc.copy()
    new[1:] |= start[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    doc, start, stop = doc[new], start[new], reach[last]
    zero = np.zeros(len(doc), np.int64)
    return doc, zero, doc, start, (stop - start).astype(np.int32), np.full(len(doc), kind, np.int8)


def settle(rows: Rows, before_shuffle: bool, single: bool) -> Rows:
    """What is decided about rows that share keys, and what is left to decide.

    Of equal stretches the earliest stays and the others are repeats. A key with several stretches sends the
    earliest of each to the comparison of windows (not if they are ``single`` windows, which have nothing to
    extend). Before the shuffle, what stays goes on, and a key that is already known to be mixed sends a mark
    instead, so that it never gathers many rows.
    """
    done = rows[5] <= UNSETTLED
    out = [_pick(rows, done)]
    rows = _pick(rows, ~done)
    rows = _pick(rows, np.lexsort((rows[3], rows[2], rows[1], rows[0])))
    key, check, doc, start, _, kind = rows
    if len(key):
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new = new_key.copy()
        new[1:] |= check[1:] != check[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ~new & ((doc != doc[head]) | (start != start[head])) & (kind == STRETCH)
        out.append(merged(_pick(rows, again), REPEATED))
        group = np.cumsum(new_key) - 1
        several = np.bincount(group, new) > 1
        several |= np.bincount(group, kind == MIXED) > 0
        several = several[group] & (not single)
        out.append(merged(_pick(rows, new & several & (kind == STRETCH)), UNSETTLED))
        if before_shuffle:
            out.append(_pick(rows, new & ~several))
            mark = _pick(rows, new_key & several)
            out.append((mark[0], np.zeros_like(mark[1]), mark[2], mark[3], mark[4], np.full(len(mark[0]), MIXED, np.int8)))
    return _rows(out)


def _batch(rows: Rows) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 200_000]) for c in rows], schema=_SCHEMA)


def _blocks(parts: Iterable[Rows], single: bool) -> Iterator[pa.RecordBatch]:
    """Settles rows in blocks before the shuffle."""
    held: list[Rows] = []
    size = 0
    for rows in parts:
        held.append(rows)
        size += len(rows[0])
        if size >= BLOCK_ROWS:
            yield from _batch(settle(_rows(held), True, single))
            held, size = [], 0
    yield from _batch(settle(_rows(held), True, single))


def _hash_words(texts: list[str]) -> list[np.ndarray]:
    memory = _memory()
    return [memory.of(x.encode().split()) for x in texts]


_WORDS: list[WordHashes] = []


def _memory() -> WordHashes:
    if not _WORDS:
        _WORDS.append(WordHashes())
    return _WORDS[0]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[Rows]:
        for part in slices(batches, "text"):
            yield stretches(_hash_words(texts_of(part.column(1))), part.column(0).to_numpy())

    yield from _blocks(parts(), single=False)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[Rows]:
        for part in slices(batches, "text"):
            spans = part.column(2).to_pylist()
            hashes = _hash_words(texts_of(part.column(1)))
            for doc, own, s in zip(part.column(0).to_pylist(), hashes, spans, strict=True):
                yield windows(own, doc, [(x["start"], x["n"]) for x in s])

    yield from _blocks(parts(), single=True)


def _settled(single: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's rows may lie in several batches."""
        held: list[Rows] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(c.to_numpy() for c in batch.columns)
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut or (held and held[-1][0][-1] != rows[0][0]):
                yield from _batch(settle(_rows([*held, _pick(rows, np.arange(cut))]), False, single))
                held = []
            held.append(_pick(rows, np.arange(cut, len(rows[0]))))
        if held:
            yield from _batch(settle(_rows(held), False, single))

    return run


def _by_key(rows: DataFrame, single: bool) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_settled(single), ROWS)


def _spans(rows: DataFrame, kind: int) -> DataFrame:
    """All spans of a kind, one row per document."""
    return rows.where(F.col("kind") == kind).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, spans) of windows that repeat an earlier one: arrays of (first window, windows), maybe overlapping.

    ``texts`` has ``doc`` and ``text``. Step 1 is stored in the shared folder, as both later steps read it.
    """
    seeds = cut_lineage(_by_key(texts.mapInArrow(_seeds, ROWS), single=False))
    unsettled = texts.join(_spans(seeds, UNSETTLED), "doc").select("doc", "text", "spans")
    extended = _by_key(unsettled.mapInArrow(_extended, ROWS), single=True)
    return _spans(seeds.unionByName(extended), REPEATED)


def kept_words(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    """The words that no window of the spans covers."""
    if not spans:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        steps[s["start"]] += 1
        steps[min(s["start"] + s["n"] + LENGTH - 1, len(words))] -= 1
    covered = np.cumsum(steps[:-1]) > 0
    return [w for w, c in zip(words, covered.tolist(), strict=True) if not c]


_RESULT = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        docs, counts, removed, kept = part.column(0), [], [], []
        for text, spans in zip(texts_of(part.column(1)), part.column(2).to_pylist(), strict=True):
            words = text.encode().split()
            left = kept_words(words, spans)
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays([docs, pa.array(counts), pa.array(removed), pa.array(kept, pa.string())], schema=_RESULT)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, text`` (kept words joined by blanks).

    A word goes if a window of LENGTH words covers it whose words also start earlier, in a document with a smaller
    id or further up in the same one. A null or empty text has no words. Rows with the same id are one document for
    this: none of them is earlier than the other at the same start, and each loses the windows that any of them
    loses. A null id is smaller than any other and stays null. An empty table gives no rows.
    """
    texts = texts_by_id(docs, id_col, text_col)
    found = texts.join(repeated_spans(texts), "doc", "left").select("doc", "text", "spans")
    cleaned = found.mapInArrow(_cleaned, "doc long, n_words long, n_removed long, text string")
    return cleaned.select(named_id(F.col("doc")).alias("doc_id"), "n_words", "n_removed", "text")
