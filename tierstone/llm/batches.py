"""What the operators share: texts out of Arrow batches, whole-batch word hashes, named steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes that one slice of a batch holds at most (a single longer text is a slice of its own).
SLICE_BYTES = 4_000_000
#: Words whose hashes one Python worker keeps before it starts anew.
KEPT_WORDS = 400_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; a null is the empty text."""
    return [x if x is not None else "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task holds at once does not depend on text lengths."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0).to_pylist()
        first, size = 0, 0
        for i, n in enumerate(lengths):
            if size and size + n > most:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += n
        if first < batch.num_rows:
            yield batch.slice(first)


def id_column(name: str) -> Column:
    """A row id as a long; a null id is the least long, so that it still joins and orders."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-(2**63)))


def named_id(column: Column) -> Column:
    """The id as it came: the least long is null again."""
    return F.when(column != F.lit(-(2**63)), column)


def texts_by_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only what an operator reads, under names of its own, whatever else the table has."""
    return docs.select(id_column(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))


class WordHashes(dict):
    """XXH64 of each word (bytes), remembered while the worker lives, up to KEPT_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive word hashes; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * MULTIPLIER + h[j : j + n]
    return mix(out)


def range_hashes(h: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the word hashes [first, end) of each range, whatever stands around it."""
    powers = np.ones(len(h) + 1, np.uint64)
    np.cumprod(np.full(len(h), MULTIPLIER), out=powers[1:])
    inverse = np.ones(len(h) + 1, np.uint64)
    np.cumprod(np.full(len(h), np.uint64(pow(int(MULTIPLIER), -1, 2**64))), out=inverse[1:])
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers[:-1], out=sums[1:])
    return mix(mix((sums[end] - sums[first]) * inverse[first]) + (end - first).astype(np.uint64))
