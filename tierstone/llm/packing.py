"""Pack token sequences into fixed windows: non-negative least squares over length combinations.

Documents longer than the window give full windows, which need no packing. What is left of each document is a
piece shorter than the window. The pieces of a block are counted in a histogram of lengths (on a grid), all
combinations of up to DEPTH lengths that fill a window are enumerated, non-negative least squares says how often
to use each of them, the counts are rounded down to what the histogram has, and what remains is packed greedily:
largest first, then the best fit, at last a cut that fills the window.

There is no shuffle: a task packs the rows it reads, block after block, and holds one block. What does not fill a
window at the end of a block goes into the next one; at the end of the task it is cut to powers of two, which need
no padding. Packing again the same rows of a task gives the same result, and sequence ids hold the partition's
number, so a repeated task is harmless.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tierstone.llm.batches import named_id, slices, texts_by_id, texts_of

#: Lengths are counted in steps of so many tokens.
GRID = 8
#: A combination has so many pieces at most.
DEPTH = 3
#: Tokens in a block; its ids are held in memory.
BLOCK_TOKENS = 6_000_000
#: A window with fewer free places than this is left as it is, not filled by a cut.
LEAST_CUT = 24

ROWS = "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([(x.split()[0], pa.int64()) for x in ROWS.split(", ")])
#: How a byte-level tokenizer splits text before it merges (a fixed value, written without backtracking).
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


class TextEncoder:
    """Token ids of whole texts as the tokenizer file says, special tokens in a text included.

    A byte-level BPE file whose ids follow its merges is run by the faster of the two installed engines, which
    gives the same ids; any other file by the engine it was made for.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._fast = self._slow = None
        ranks = _byte_ranks(spec)
        if ranks:
            special = {x["content"]: x["id"] for x in spec["added_tokens"]}
            self._fast = tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
            size = self._fast.n_vocab
        else:
            self._slow = Tokenizer.from_file(path)
            size = self._slow.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._fast:
            return [self._fast.encode_to_numpy(x, allowed_special="all").astype(self.kind) for x in texts]
        found = self._slow.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind) for x in found]


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by bytes if they are the merge order too and nothing else happens to a text; else None."""
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    odd = [x for x in spec["added_tokens"] if x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]]
    if model["type"] != "BPE" or not plain or spec["normalizer"] or spec["post_processor"] or odd or model.get("dropout"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
    special = {x["content"] for x in spec["added_tokens"]}
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merged = [vocab[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    if merged != sorted(set(merged)) or len(vocab) != len(merged) + 256 or max(map(len, vocab), default=0) == 0:
        return None
    return {bytes(byte_of[c] for c in k): v for k, v in vocab.items()}


@cache
def combinations(units: int, depth: int) -> np.ndarray:
    """All ways to write ``units`` as a sum of up to ``depth`` lengths, each row descending, 0 for none."""
    rows: list[list[int]] = []

    def extend(head: list[int], rest: int) -> None:
        top = min(rest, head[-1] if head else units)
        if rest == 0:
            rows.append(head + [0] * (depth - len(head)))
        elif len(head) < depth:
            left = depth - len(head)
            for x in range(top, -(-rest // left) - 1, -1):
                extend([*head, x], rest - x)

    extend([], units)
    return np.array(rows, np.int64)


def least_squares_counts(histogram: np.ndarray, ways: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 that makes the summed lengths of x-fold combinations come nearest to the histogram (index: length).

    Accelerated projected gradient; each combination touches few lengths, so a step costs its few entries.
    """
    n = len(histogram)
    used = ways > 0
    flat = ways.ravel()

    def lengths(x: np.ndarray) -> np.ndarray:
        total = np.bincount(flat, np.repeat(x, ways.shape[1]), n)
        total[0] = 0
        return total

    v = np.random.default_rng(0).random(len(ways))
    for _ in range(15):
        v = (lengths(v)[ways] * used).sum(1)
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(ways))
    t = 1.0
    for _ in range(rounds):
        slope = ((lengths(y) - histogram)[ways] * used).sum(1)
        new = np.maximum(0, y - slope / top)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def plan_windows(lengths: list[int], window: int, last: bool) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int]]]:
    """Windows as lists of (piece, start in the piece, length), and (piece, start) of what is left for later.

    ``lengths`` are under the window. With ``last`` nothing is left: the end is cut to powers of two.
    """
    grid = min(GRID, window)
    units = window // grid
    by_unit: list[list[int]] = [[] for _ in range(units + 1)]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        by_unit[-(-lengths[i] // grid)].append(i)
    for bin_ in by_unit:
        bin_.reverse()
    windows: list[list[tuple[int, int, int]]] = []
    if units > 1 and len(lengths) > 1:
        ways = combinations(units, DEPTH)
        ways = ways[(ways[:, 1] > 0)]
        have = np.array([len(x) for x in by_unit], float)
        counts = least_squares_counts(have, ways)
        for w in np.argsort(-counts, kind="stable"):
            times = round(float(counts[w]))
            if not times:
                break
            parts = [int(x) for x in ways[w] if x]
            for _ in range(times):
                if any(len(by_unit[x]) < parts.count(x) for x in parts):
                    break
                windows.append([(i, 0, lengths[i]) for i in (by_unit[x].pop() for x in parts)])
    rest = sorted((lengths[i], i, 0) for bin_ in by_unit for i in bin_)
    while rest:
        free, here = window, []
        while rest and free:
            at = bisect_right(rest, (free, len(lengths), 0)) - 1
            if at >= 0:
                n, i, start = rest.pop(at)
            elif free < LEAST_CUT:
                break
            else:
                n, i, start = rest.pop()
                left = (n - free, i, start + free)
                rest.insert(bisect_right(rest, left), left)
                n = free
            here.append((i, start, n))
            free -= n
        if free >= LEAST_CUT and not last:
            return windows, [(i, start) for i, start, _ in here]
        if free >= LEAST_CUT:
            windows.extend(_powers_of_two(here, window - free))
        else:
            windows.append(here)
    return windows, []


def _powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """The same tokens in windows whose sizes are powers of two."""
    todo = pieces[::-1]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        here = []
        while size:
            i, start, n = todo.pop()
            take = min(n, size)
            here.append((i, start, take))
            if take < n:
                todo.append((i, start + take, n - take))
            size -= take
        yield here


class _Packer:
    """Packs the documents of one task; ``held`` are (doc, all ids, first id not yet packed)."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id = window, first_id
        self.held: list[tuple[int, np.ndarray, int]] = []

    def _row(self, doc: int, ids: np.ndarray, start: int, n: int, offset: int) -> tuple[int, ...]:
        crc = zlib.crc32(ids[start : start + n].astype("<u4").tobytes())
        return doc, start, n, crc, len(ids), self.next_id, offset

    def flush(self, docs: list[tuple[int, np.ndarray]], last: bool) -> Iterator[tuple[int, ...]]:
        todo = self.held
        self.held = []
        for doc, ids in docs:
            end = len(ids) - len(ids) % self.window
            for start in range(0, end, self.window):
                yield self._row(doc, ids, start, self.window, 0)
                self.next_id += 1
            if end < len(ids):
                todo.append((doc, ids, end))
        windows, left = plan_windows([len(ids) - start for _, ids, start in todo], self.window, last)
        for pieces in windows:
            offset = 0
            for i, at, n in pieces:
                doc, ids, start = todo[i]
                yield self._row(doc, ids, start + at, n, offset)
                offset += n
            self.next_id += 1
        self.held = [(todo[i][0], todo[i][1], todo[i][2] + at) for i, at in left]


def _batches(rows: Iterable[tuple[int, ...]]) -> Iterator[pa.RecordBatch]:
    table = np.array(list(rows), np.int64).reshape(-1, len(_SCHEMA))
    if len(table):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(table.T)], schema=_SCHEMA)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
    end_id: int = 1, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document is its text's ids and ``end_id``; each id lies in exactly one piece. A null or empty text is the
    end id alone. Rows that repeat, or share an id, are documents of their own; a null id stays null. Columns other
    than the two named play no part. An empty table gives no rows. ``window`` has to be a power of two.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        packer = _Packer(window, TaskContext.get().partitionId() << 40)
        block: list[tuple[int, np.ndarray]] = []
        size = 0
        for part in slices(batches, "text"):
            ids = encoder.encode(texts_of(part.column(1)))
            for doc, x in zip(part.column(0).to_pylist(), ids, strict=True):
                block.append((doc, np.append(x, x.dtype.type(end_id))))
                size += len(x) + 1
            if size >= block_tokens:
                yield from _batches(packer.flush(block, last=False))
                block, size = [], 0
        yield from _batches(packer.flush(block, last=True))

    packed = texts_by_id(docs, id_col, text_col).mapInArrow(pack, ROWS)
    return packed.select(named_id(packed["doc"]).alias("doc_id"), *packed.columns[1:])


@cache
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)
