"""Sampled segmentations over a piece lattice: filter forwards, sample backwards; decoding gives the text back.

A text is split before each run of blanks; a part, a run of word marks and what follows it, is a lattice of its own if
no piece of the vocabulary has a word mark behind another character (else the text is one part). The forward pass sums
the weights of all ways to each place; the backward pass starts at the end and draws, again and again, the last piece in
proportion to the ways that end with it, so each segmentation comes with its exact probability. Draws are a function of
the row's key, the part's place in the text and the step, so a row's segmentation is the same in every run, on any
machine and in any batch.

Both passes run over all distinct parts of a slice of texts at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import MULTIPLIER, mix, named_id, slices, texts_by_id, texts_of

MARK = "▁"
#: Stands for a word mark that the text itself holds, which is no blank; no text holds this.
OWN_MARK = "\ud800"
#: A run of blanks and what stands up to the next.
_PARTS = re.compile(f"{MARK}+[^{MARK}]*")
#: Powers the pieces' probabilities: near 0 all segmentations are alike, above 1 the likely ones come more often.
SHARPNESS = 1.0
#: Characters of the texts that go through the lattice together.
SLICE_CHARS = 1_000_000
#: Log probability of each byte of a character that no piece has.
BYTE_WEIGHT = -12.0


class PieceTable:
    """Pieces by the hash of their characters, and all their beginnings, in open hash tables."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.first_byte = next(i for i in range(size) if model.is_byte(i))
        usable = [i for i in range(size) if i not in special]
        self.crossed = any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in usable)
        scores = np.array([model.get_score(i) for i in usable])
        ranked = scores[scores > scores.min()]
        if len(set(ranked.tolist())) == len(ranked) and np.all(scores == np.round(scores)):
            # A merge list has ranks in place of probabilities; by Zipf's law they fall as one over the rank. Pieces that
            # share the least score, as runs of marks may, share the last rank.
            scores = -np.log(2.0 + np.searchsorted(np.sort(-scores), -scores))
            scores -= np.log(np.exp(scores).sum())
        self.weight = np.zeros(size)
        self.weight[usable] = scores
        self.longest = max(len(self.pieces[i]) for i in usable)
        # value: twice the id plus one (0 if the characters only begin a piece), odd if a longer piece begins so
        values: dict[int, int] = {}
        for i in usable:
            h = 0
            for k, c in enumerate(self.pieces[i], 1):
                h = self.extended(h, c)
                values[h] = values.get(h, 0) | (k < len(self.pieces[i]))
            values[h] += 2 * (i + 1)
        self.known = HashTable(np.array(list(values), np.uint64), np.array(list(values.values()), np.int32))
        texts = [bytes([i - self.first_byte]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.text_size = np.array([len(x) for x in texts], np.int64)
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.text = np.frombuffer(b"".join(texts), np.uint8)

    def parts(self, text: str) -> list[str]:
        """The parts of a text, each a lattice of its own, with marks for blanks."""
        marked = MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)
        return [marked] if self.crossed else _PARTS.findall(marked)

    @staticmethod
    def extended(h: int, c: str) -> int:
        return (h * int(MULTIPLIER) + ord(c) + 1) % 2**64


class HashTable:
    """64-bit keys to values of 0 and more; -1 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.probes = 1
        for k, v, at in zip(keys, values, self._slot(keys).tolist(), strict=True):
            probes = 1
            while self.values[at] >= 0:
                at, probes = (at + 1) & self.mask, probes + 1
            self.keys[at], self.values[at] = k, v
            self.probes = max(self.probes, probes)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def look(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.values[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            hit = self.keys[at[open_]] == keys[open_]
            out[open_] = np.where(hit, self.values[at[open_]], -1)
            open_ = open_[~hit & (self.values[at[open_]] >= 0)]
        return out


class Lattice:
    """The lattices of distinct words, laid side by side.

    Words are ordered by length, longest first, so the words that reach a place are the first few, and characters
    and nodes are numbered place by place: first the starts of all words, then the nodes behind their first
    characters, and so on. Edges are ordered by the node they end at, which is then the order of the forward pass.
    ``draw`` holds, for each edge, its end node plus the chance of it and of the edges before it at that node, so one
    search in it draws an edge.
    """

    def __init__(self, table: PieceTable, words: list[str], sharpness: float):
        sizes = np.array([len(w) for w in words], np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        sizes = sizes[by_size]
        n_words, n = len(words), int(sizes.sum())
        reach = np.searchsorted(-sizes, -np.arange(int(sizes[0]) + 1), side="left") if n_words else np.zeros(1, np.int64)
        base = np.append(0, np.cumsum(reach))[: len(reach)]  # reach[p]: words longer than p characters
        typed = np.frombuffer("".join(words[i] for i in by_size).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(n_words), sizes)
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes = np.empty(n, np.uint64)
        codes[base[place] + word] = typed
        place = np.repeat(np.arange(len(reach)), reach)
        word = np.arange(n) - base[place]
        src = np.where(place > 0, n_words + base[np.maximum(place - 1, 0)] + word, word).astype(np.int32)
        room = sizes[word] - place
        own = src
        hashes = np.zeros(n, np.uint64)
        single = np.zeros(n, bool)
        parts = []
        for k in range(table.longest):
            char = base[place + k] + word
            hashes = hashes * MULTIPLIER + codes[char] + np.uint64(1)
            value = table.known.look(hashes)
            hit = np.flatnonzero(value > 1)
            if k == 0:
                single[char[hit]] = True
            parts.append((own[hit], char[hit].astype(np.int32), (value[hit] >> 1) - 1))
            more = np.flatnonzero((value & 1).astype(bool) & (value >= 0) & (room > k + 1))
            if not len(more):
                break
            place, word, room, own, hashes = place[more], word[more], room[more], own[more], hashes[more]
        odd = np.flatnonzero(~single).astype(np.int32)
        codes[codes == np.uint64(ord(OWN_MARK))] = ord(MARK)
        parts.append((src[odd], odd, -codes[odd].astype(np.int32) - 1))
        degree = np.zeros(n + 1, np.int64)
        for _, char, _ in parts:
            degree[char + 1] += 1  # a node has one edge of each length at most
        self.edges = np.cumsum(degree)
        total = int(self.edges[-1])
        self.src, self.piece, end = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, np.int32)
        fill = self.edges[:-1].copy()
        for source, char, piece in parts:
            at = fill[char]
            self.src[at], self.piece[at], end[at] = source, piece, char
            fill[char] += 1
        code = -self.piece - 1
        self.size = np.where(self.piece >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)).astype(np.int8)
        weight = np.where(self.piece >= 0, table.weight[np.maximum(self.piece, 0)], BYTE_WEIGHT * self.size) * sharpness
        self.ways = np.zeros(n_words + n)
        chance = np.empty(total)
        bounds = np.append(base, n)
        for p in range(len(reach) - 1):
            new = self.edges[bounds[p] : bounds[p + 1]]
            a, b = int(new[0]), int(self.edges[bounds[p + 1]])
            heads = new - a
            score = self.ways[self.src[a:b]] + weight[a:b]
            degrees = np.diff(np.append(heads, b - a))
            top = np.maximum.reduceat(score, heads)
            part = np.exp(score - np.repeat(top, degrees))
            whole = np.add.reduceat(part, heads)
            self.ways[n_words + bounds[p] : n_words + bounds[p + 1]] = top + np.log(whole)
            run = np.cumsum(part)
            chance[a:b] = (run - np.repeat(run[heads] - part[heads], degrees)) / np.repeat(whole, degrees)
        self.draw = end + np.minimum(chance, 1.0)
        self.n_words = n_words
        self.last = np.empty(n_words, np.int64)
        self.last[by_size] = n_words + base[sizes - 1] + np.arange(n_words)

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of one segmentation of each word, in order, word after word; and how many each has."""
        node, who = self.last[word] - self.n_words, np.arange(len(word))
        count = np.zeros(len(word), np.int64)
        taken = []
        step = 0
        while len(who):
            u = (mix(key + np.uint64(step)) >> np.uint64(11)) * 2.0**-53
            edge = np.searchsorted(self.draw, node + u, side="right")
            edge = np.clip(edge, self.edges[node], self.edges[node + 1] - 1)
            taken.append((who, edge))
            count[who] += 1
            node = self.src[edge].astype(np.int64) - self.n_words
            more = np.flatnonzero(node >= 0)
            who, node, key = who[more], node[more], key[more]
            step += 1
        ends = np.cumsum(count)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for step, (who, edge) in enumerate(taken):
            out[ends[who] - 1 - step] = edge
        return out, count


def encode_sampled(table: PieceTable, texts: list[str], keys: np.ndarray, sharpness: float = SHARPNESS) -> list[np.ndarray]:
    """A sampled segmentation of each text, as ids."""
    parts = [table.parts(x) for x in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    number: dict[str, int] = {}
    word = np.fromiter((number.setdefault(w, len(number)) for p in parts for w in p), np.int64, int(sizes.sum()))
    lattice = Lattice(table, list(number), sharpness)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = mix(np.repeat(keys, sizes) + place.astype(np.uint64) * MULTIPLIER)
    edges, count = lattice.sample(word, key)
    size = lattice.size[edges].astype(np.int64)
    ids = np.repeat(lattice.piece[edges], size)
    starts = np.cumsum(size) - size
    for at in np.flatnonzero(lattice.piece[edges] < 0).tolist():
        raw = chr(-int(lattice.piece[edges[at]]) - 1).encode()
        ids[starts[at] : starts[at] + len(raw)] = [table.first_byte + b for b in raw]
    per_word = np.add.reduceat(size, np.cumsum(count) - count) if len(count) else size
    per_text = np.add.reduceat(per_word, np.cumsum(sizes) - sizes) if len(sizes) else sizes
    return np.split(ids.astype(np.int32), np.cumsum(per_text)[:-1]) if len(texts) else []


def decode(table: PieceTable, ids: np.ndarray) -> str:
    """The text of ids; word marks are blanks, the first of them is no part of the text."""
    size = table.text_size[ids]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return table.text[np.repeat(table.text_start[ids], size) + within].tobytes().decode("utf-8", "replace")[1:]


@cache
def _table(path: str) -> PieceTable:
    return PieceTable(path)


def sampled_ids(text: Column, key: Column, model_path: str, *, sharpness: float = SHARPNESS, seed: int = 0) -> Column:
    """Ids of a segmentation drawn for each text; ``key`` names the row (a long; null counts as 0).

    Equal texts with equal keys get equal ids. A null text is null, an empty one is the word mark alone, any other
    character that no piece has comes as its bytes, a word mark in the text too. ``seed`` gives other draws.
    """
    def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
        table, rows = _table(model_path), texts_of(texts)
        keys_ = mix(np.array(keys.fill_null(0).to_pylist(), np.int64).view(np.uint64) + np.uint64(seed) * MULTIPLIER)
        out: list[np.ndarray] = []
        at = 0
        while at < len(rows):
            end, size = at + 1, len(rows[at])
            while end < len(rows) and size + len(rows[end]) <= SLICE_CHARS:
                size += len(rows[end])
                end += 1
            out += encode_sampled(table, rows[at:end], keys_[at:end], sharpness)
            at = end
        sizes = [len(x) for x in out]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=None)
        flat = pa.array(np.concatenate([*out, np.empty(0, np.int32)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, flat, mask=texts.is_null() if texts.null_count else None)

    # Spark would run a deterministic function once more inside each function of Python that takes its result.
    return F.arrow_udf(encode, "array<int>").asNondeterministic()(text, key.cast("long"))


_RESULT = pa.schema([("doc", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def sampled_documents(
    docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", sharpness: float = SHARPNESS, seed: int = 0
) -> DataFrame:
    """``doc_id``, the ``ids`` drawn for its text with the id as key, and the ``text`` that these ids decode to.

    Like ``sampled_ids``, but a task holds one slice of texts at a time and returns it before the next. A null text
    has null ids and text; a null id draws as the least long and stays null. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_path)
        for part in slices(batches, "text", SLICE_CHARS):
            texts = part.column(1).to_pylist()
            keys = mix(part.column(0).to_numpy().view(np.uint64) + np.uint64(seed) * MULTIPLIER)
            ids = encode_sampled(table, [x or "" for x in texts], keys, sharpness)
            back = [None if x is None else decode(table, i) for x, i in zip(texts, ids, strict=True)]
            ids = [None if x is None else i for x, i in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, _RESULT.field("ids").type), pa.array(back, pa.string())], schema=_RESULT)

    found = texts_by_id(docs, id_col, text_col).mapInArrow(run, "doc long, ids array<int>, text string")
    return found.select(named_id(F.col("doc")).alias("doc_id"), "ids", "text")


def decoded_text(ids: Column, model_path: str) -> Column:
    """The text that the ids stand for; null for null."""
    def join(column: pa.Array) -> pa.Array:
        table = _table(model_path)
        ids, ends, null = column.values.to_numpy(), column.offsets.to_pylist(), column.is_null().to_pylist()
        return pa.array([None if n else decode(table, ids[a:b]) for n, a, b in zip(null, ends, ends[1:])], pa.string())

    return F.arrow_udf(join, "string")(ids)
