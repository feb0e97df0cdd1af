"""Repeated windows against brute force."""

import random

import numpy as np
import pytest

from tierstone.llm import substring_dedup as s


def brute(docs):
    seen, out = {}, {}
    for d, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        words = (text or "").encode().split()
        covered = [False] * len(words)
        for i in range(len(words) - s.LENGTH + 1):
            key = tuple(words[i : i + s.LENGTH])
            if seen.setdefault(key, (d, i)) != (d, i):
                covered[i : i + s.LENGTH] = [True] * s.LENGTH
        out[d] = (len(words), sum(covered), b" ".join(w for w, c in zip(words, covered) if not c).decode())
    return out


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: r.choice("ab") if r.random() < 0.3 else "w%d" % r.randrange(400)
    passages = [[word() for _ in range(r.randrange(15, 90))] for _ in range(8)]
    docs = []
    for d in range(n):
        words = []
        for _ in range(r.randrange(0, 5)):
            kind = r.random()
            if kind < 0.5:
                words += [word() for _ in range(r.randrange(1, 60))]
            elif kind < 0.8:
                p = list(r.choice(passages))
                a = r.randrange(len(p))
                p = p[a:] if r.random() < 0.5 else p
                if r.random() < 0.4 and p:
                    p[r.randrange(len(p))] = "edit%d" % d
                words += p
            else:
                words += ["same"] * r.randrange(5, 70)
        docs.append((d * 7 + 1, r.choice([" ", "\n", "\t", "  "]).join(words)))
    docs += [(5000 + i, docs[i][1]) for i in range(20)] + [(9000, None), (9001, ""), (None, docs[3][1]), (9002, " ".join(["x y"] * 3000))]
    return docs


@pytest.mark.parametrize("seed, block, partitions", [(1, 1_500_000, 1), (2, 300, 5), (3, 60, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, block, partitions):
    monkeypatch.setattr(s, "BLOCK_ROWS", block)  # seen by forked workers where it matters; the result must not change
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, key string, n int").repartition(partitions)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in s.without_repeats(df).collect()}
    assert got == brute(docs)


def test_settling_in_blocks_changes_nothing():
    docs = corpus(5)
    hashes = s._hash_words([t or "" for _, t in docs])
    ids = np.array([-1 if d is None else d for d, _ in docs])

    def repeats(parts):
        rows = s.settle(s._rows(parts), False, False)
        return {(int(d), i) for d, a, n, k in zip(rows[2], rows[3], rows[4], rows[5]) if k == s.REPEATED for i in range(a, a + n)}, {
            (int(d), i) for d, a, n, k in zip(rows[2], rows[3], rows[4], rows[5]) if k == s.UNSETTLED for i in range(a, a + n)
        }

    whole = repeats([s.stretches(hashes, ids)])
    parts = [s.settle(s.stretches(hashes[i : i + 9], ids[i : i + 9]), True, False) for i in range(0, len(docs), 9)]
    split = repeats(parts)
    assert whole[0] <= split[0] | split[1] and split[0] <= whole[0] | whole[1]


def test_anchors_follow_the_words_of_a_window():
    x = np.array([5, 3, 3, 9, 1, 7, 1, 8], np.uint64)
    assert s.last_least(x, 3).tolist() == [2, 2, 4, 4, 6, 6]


def test_repeated_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in s.without_repeats(df).collect()) == [(1, 0), (1, 0), (2, 30)]
    assert s.without_repeats(df.limit(0)).collect() == []
