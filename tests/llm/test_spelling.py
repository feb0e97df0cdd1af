"""Words one edit apart, against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from tierstone.llm import spelling as s


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed, n, letters):
    rd = random.Random(seed)
    stems = ["".join(rd.choice(letters) for _ in range(rd.randrange(4, 9))) for _ in range(60)]
    stems += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "abababa", "ÀÉîöü", "Àéîöü", "x×÷yz"]

    def word():
        w = list(rd.choice(stems))
        if rd.random() < 0.4:
            at = rd.randrange(len(w))
            kind = rd.random()
            w[at : at + (kind < 0.66)] = [] if kind < 0.33 else [rd.choice(letters)]
        w = "".join(w)
        return w.upper() if rd.random() < 0.1 else w

    docs = [(d, rd.choice([" ", ", ", "\n", "_1"]).join(word() for _ in range(rd.randrange(60)))) for d in range(n)]
    return docs + [(n, None), (n + 1, ""), (None, docs[0][1]), (5, docs[5][1]), (5, docs[5][1]), (n + 2, "stone " * 4 + "stoné 1x")]


@pytest.mark.parametrize("seed, letters, most, partitions", [
    (1, "abc", 10_000, 1), (2, "abcdefé", 10_000, 4), (3, "ab", 0, 5), (4, "abcdeÿ", 3, 3),
])
def test_equals_brute_force(spark, seed, letters, most, partitions):
    """Also where every cell is told apart by the letters around the edit."""
    docs = corpus(seed, 300, letters)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(partitions)
    rows = s.spelling_groups(df, most_pairs=most).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == brute(docs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert s.spelling_groups(none).collect() == []
    assert s.spelling_groups(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_pivots_are_disjoint_rare_and_enough(seed):
    """Every pair one edit apart shares a pivot of one word with the prefix of the other, on an intact side."""
    rd = random.Random(seed)
    words = sorted({"".join(rd.choice("abcd") for _ in range(rd.randrange(5, 9))) for _ in range(300)})
    counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    ranks = {g: (i, counts[g]) for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    lists = dict(ranks.values())
    prefix = {w: s.prefix_of(w, ranks) for w in words}
    pivots = {w: s.pivots_of(prefix[w], lists) for w in words}
    for w, p in pivots.items():
        assert len(p) == 2 and abs(p[0][1] - p[1][1]) >= 2 and set(p) <= set(prefix[w])
        cost = min(lists[a[0]] + lists[b[0]] for a in prefix[w] for b in prefix[w] if a[1] + 2 <= b[1])
        assert sum(lists[r] for r, _ in p) == cost

    def sides(w, grams):
        return {("<", w[: at + 2]) for _, at in grams} | {(">", w[at:]) for _, at in grams}

    for a in words:
        for b in words:
            if one_edit(a, b) and prefix[a][-1][0] <= prefix[b][-1][0]:
                assert sides(a, pivots[a]) & sides(b, prefix[b])
