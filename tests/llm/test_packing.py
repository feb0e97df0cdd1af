"""Packed pieces: every id once, windows full, ids as the tokenizer gives them."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierstone.llm import packing as p

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a  b", "a \n b", "\n\n  b", "a b  c", "<|endoftext|> a<|endoftext|>", "it's we'll 'S", "\t\tq", "a\x1c b",
    "é ñ 漢字 😀", "x\r\n\r\ny", "1234567 89", "a\u0085b", "  lead and trail  ",
]


def test_ids_are_the_tokenizers():
    own = p.TextEncoder(PATH)
    want = Tokenizer.from_file(PATH).encode_batch(ODD, add_special_tokens=False)
    assert [x.tolist() for x in own.encode(ODD)] == [x.ids for x in want]
    own._fast, own._slow = None, Tokenizer.from_file(PATH)
    assert [x.tolist() for x in own.encode(ODD)] == [x.ids for x in want]


def check(rows, ids_of, window=2048):
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc, start, n, crc, total, sequence, offset in rows:
        ids = ids_of[doc]
        assert total == len(ids) and n > 0
        assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
        docs[doc].append((start, n))
        sequences[sequence].append((offset, n))
    assert set(docs) == set(ids_of)
    for doc, pieces in docs.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == len(ids_of[doc])
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / sum(map(len, ids_of.values()))


def test_packing_is_complete_and_tight(spark):
    text = lambda i: " ".join(f"word{i * j % 97}" for j in range(1 + i * i % 900))
    rows = [(i, text(i)) for i in range(400)] + [(1000 + i, x) for i, x in enumerate(ODD)] + [(2000, None), (2001, "long " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, doc string").repartition(3)
    tokenizer = Tokenizer.from_file(PATH)
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    got = [tuple(r) for r in p.pack_documents(df, PATH).collect()]
    assert check(got, ids) < 0.02
    small = [tuple(r) for r in p.pack_documents(df, PATH, block_tokens=20_000).collect()]
    assert check(small, ids) < 0.05
    assert p.pack_documents(df.limit(0), PATH).collect() == []


def test_repeated_and_null_ids_are_documents_of_their_own(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string")
    got = p.pack_documents(df.coalesce(1), PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (1, 3), (1, 3)]
    assert sorted((r.sequence_id, r.offset) for r in got) == sorted({(r.sequence_id, r.offset) for r in got})


@pytest.mark.parametrize("window", [2, 8, 64, 2048])
def test_windows_of_any_lengths(window):
    random = np.random.default_rng(window)
    for n in (0, 1, 2, 50, 700):
        lengths = random.integers(1, window, n).tolist() if window > 1 else []
        windows, left = p.plan_windows(lengths, window, last=True)
        assert not left
        used = defaultdict(list)
        for pieces in windows:
            total = sum(x[2] for x in pieces)
            assert 0 < total <= window
            for i, start, k in pieces:
                used[i].append((start, k))
        for i, size in enumerate(lengths):
            at = 0
            for start, k in sorted(used[i]):
                assert start == at
                at += k
            assert at == size


def test_least_squares_find_a_planted_mixture():
    ways = p.combinations(16, 3)
    assert all(w.sum() == 16 for w in ways) and len({tuple(w) for w in ways}) == len(ways)
    planted = np.zeros(len(ways))
    planted[[3, 11, 17]] = [40, 25, 10]
    histogram = np.bincount(ways.ravel(), np.repeat(planted, 3), 17)
    histogram[0] = 0
    x = p.least_squares_counts(histogram, ways, rounds=2000)
    assert (x >= 0).all()
    made = np.bincount(ways.ravel(), np.repeat(x, 3), 17)
    assert np.abs(made[1:] - histogram[1:]).max() < 0.5


def test_window_has_to_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        p.pack_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH, window=1000)
