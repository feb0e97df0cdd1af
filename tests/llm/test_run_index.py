"""Windows that stand elsewhere, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tierstone.llm import run_index as r


def brute(docs):
    """(bytes, removed bytes, runs, kept) of each document."""
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + r.LENGTH] for d in data for i in range(len(d) - r.LENGTH + 1))
    out = []
    for (doc, _), d in zip(docs, data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - r.LENGTH + 1):
            if seen[d[i : i + r.LENGTH]] > 1:
                gone[i : i + r.LENGTH] = True
        runs = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((doc, len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rd = random.Random(seed)
    letters = "abcdefgh \n\x00é漢"

    def junk(size):
        return "".join(rd.choice(letters) for _ in range(size))

    passages = [junk(rd.randrange(150, 900)) for _ in range(6)]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(rd.randrange(0, 4)):
            kind = rd.random()
            if kind < 0.4:
                parts.append(junk(rd.randrange(1, 400)))
            elif kind < 0.85:
                p = list(rd.choice(passages))
                for _ in range(rd.choice([0, 0, 1, 4])):
                    p[rd.randrange(len(p))] = rd.choice(letters)
                a = rd.randrange(len(p))
                parts.append("".join(p[a:] if rd.random() < 0.3 else p))
            else:
                parts.append(rd.choice(["x", "xy", "abc"]) * rd.randrange(50, 300))
        docs.append((d * 3 + 1, "".join(parts)))
    docs += [(7000 + i, docs[i][1]) for i in range(10)] + [(9000, None), (9001, ""), (9002, "x" * 5000), (9003, junk(r.LENGTH))]
    return docs


def found(df, **more):
    rows = r.without_passages(df, **more).collect()
    for row in rows:
        assert row.n_removed == sum(s.stop - s.start for s in row.spans)
    return sorted([(x.doc_id, x.n_bytes, x.n_removed, len(x.spans), bytes(x.kept)) for x in rows], key=str)


@pytest.mark.parametrize("seed, most, partitions", [(1, 5_000, 1), (2, 1, 5), (3, 3, 4)])
def test_equals_brute_force(spark, seed, most, partitions):
    """Also where nearly every anchor has too many strings and is refined again and again."""
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, start int, key string").repartition(partitions)
    assert found(df, most_strings=most) == brute(docs)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rd = random.Random(4)
    text = "".join(rd.choice("abc") for _ in range(300))
    other = text[::-1]
    docs = [(1, text), (1, text), (None, "z" + text[:250]), (2, "other"), (3, other[:220]), (3, "q" * 10 + other)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == sorted([(1, 300, 300, 1, b"")] * 2 + [(None, 251, 250, 1, b"z"), (2, 5, 0, 0, b"other"), (3, 220, 220, 1, b""),
                              (3, 310, 220, 1, b"q" * 10 + other[220:].encode())], key=str)
    assert found(df.limit(0)) == []


def test_long_texts_are_read_in_pieces():
    """A window over the border of two pieces belongs to one of them."""
    rd = random.Random(5)
    data = bytes(rd.randrange(256) for _ in range(r.PIECE + 1000))
    pieces = list(r._cut(1, 0, data))
    rows = r.strings_of(pieces, 0)
    starts = np.concatenate([np.arange(a, a + n) for a, n in zip(rows[r.START], rows[r.N])])
    assert len(pieces) == 2 and np.array_equal(np.sort(starts), np.arange(len(data) - r.LENGTH + 1))


@pytest.mark.parametrize("here", [1, 3, 64])
def test_settling_in_blocks_loses_no_repeat(monkeypatch, here):
    """However rows are dealt before the shuffle, the same windows repeat or are compared."""
    monkeypatch.setattr(r, "MIXED_HERE", here)
    docs = [(d, (t or "").encode()) for d, t in corpus(6)]
    strings = [r.strings_of([(d, 0, 0, 0, 1, t)], 0) for d, t in docs]

    def cover(rows, kinds):
        return {(int(d), i) for d, a, n, k in zip(rows[r.DOC], rows[r.START], rows[r.N], rows[r.KIND]) if k in kinds for i in range(a, a + n)}

    whole = r.settle(r._rows(strings), False)
    blocks = r._rows([r.settle(r._rows(strings[i : i + 7]), True) for i in range(0, len(strings), 7)])
    blocks = r._pick(blocks, np.argsort(blocks[r.DEAL], kind="stable"))
    cuts = np.flatnonzero(np.diff(blocks[r.DEAL])) + 1
    parts = [r.settle(r._pick(blocks, w), False) for w in np.split(np.arange(len(blocks[0])), cuts)]
    split = r._rows(parts)
    assert cover(whole, {r.REPEATED}) <= cover(split, {r.REPEATED, r.COMPARED})
    assert cover(split, {r.REPEATED}) <= cover(whole, {r.REPEATED})
    assert {k for k, c in zip(whole[r.KEY], whole[r.KIND]) if c == r.COMPARED} <= {k for k, c in zip(split[r.KEY], split[r.KIND]) if c == r.COMPARED}


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_runs(seed):
    rd = np.random.default_rng(seed)
    text = rd.integers(0, rd.integers(1, 5), rd.integers(1, 150)).astype(np.uint8)
    text = np.tile(text[:9], 15) if seed % 4 == 0 else text
    order = r.suffix_order(text, 5)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_index_has_fewer_runs_for_copies():
    rd = random.Random(8)
    one = bytes(rd.randrange(97, 110) for _ in range(3000))
    index = r.RunIndex([one, b"q" + one, one[:2000] + b"!" + one[2000:], b"\x00" * 300])
    assert index.run_lengths.sum() == len(index.data) and len(index.run_lengths) < 1.3 * len(one)
    string, start, n = index.repeated()
    spans = {s: sorted({(int(a), int(a + k)) for t, a, k in zip(string, start, n) if t == s}) for s in range(4)}
    assert spans[0][0][0] == 0 and max(b for _, b in spans[1]) == 3000 - r.LENGTH + 2 and spans[3]
