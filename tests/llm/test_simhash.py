"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tierstone.llm import simhash as s
from tierstone.llm.components import components


def by_rule(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest position reachable through links, for each."""
    left, out = set(range(len(prints))), {}
    while left:
        todo = group = {left.pop()}
        while todo:
            near = {j for j in left if any(bin(prints[i] ^ prints[j]).count("1") <= 4 for i in todo)}
            left -= near
            group = group | near
            todo = near
        out |= dict.fromkeys(group, min(group))
    return out


def test_fingerprint_rule():
    r = random.Random(0)
    for n in (0, 1, 2, 3, 4, 5, 9, 40):
        text = "".join(r.choice([" ", "\n", "\x0b", " "]) + r.choice(["Über", "ÀB", "Word", "x" * 9]) for _ in range(n))
        assert s.fingerprint(text) == by_rule(text)


def test_links_and_components_equal_brute_force(spark):
    r = random.Random(4)
    prints = [r.getrandbits(64) for _ in range(60)]
    for i in range(60):
        x = prints[i]
        for _ in range(r.randrange(4)):  # chains
            for b in r.sample(range(64), r.randrange(1, 7)):
                x ^= 1 << b
            prints.append(x)
    prints += [p ^ sum(1 << b for b in (13 * k + 5 for k in range(1, 5))) for p in prints[:10]]  # one bit in four blocks
    prints = list(dict.fromkeys(prints))
    r.shuffle(prints)
    rows = [(int(np.uint64(p).astype(np.int64)), i) for i, p in enumerate(prints)]
    links = s.link_fingerprints(spark.createDataFrame(rows, "fp long, first long").repartition(3))
    want = groups(prints)
    assert all(want[a] == want[b] for a, b in links.collect())
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert {i: got.get(i, i) for i in range(len(prints))} == want


def test_dense_group_gives_few_links(spark):
    near = [1 << a | 1 << b for a in range(40) for b in range(a)]
    rows = [(x, i) for i, x in enumerate(near)]
    links = s.link_fingerprints(spark.createDataFrame(rows, "fp long, first long"))
    assert links.count() < 40 * len(near)
    assert components(links, "a", "b").select("component").distinct().count() == 1


def test_components_of_a_long_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}


def test_documents(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text), (3, text.upper()), (9, text.replace("w150", "other")), (4, None), (2, ""), (8, " \n "), (7, "a b c"), (None, "a b c")]
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id long, text string, fp int, component string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in s.near_copies(df).collect()}
    assert {d: int(f, 16) for d, (f, _) in got.items()} == {d: by_rule(t or "") for d, t in rows}
    assert all(len(f) == 16 for f, _ in got.values())
    assert got[4][1] == got[2][1] == got[8][1] == 2 and got[5][1] == got[3][1] == 3 and got[7][1] is None
    kept = s.without_near_copies(df)
    assert kept.columns == df.columns
    want = {d for d, (_, c) in got.items() if c == d}
    assert {r.doc_id for r in kept.collect()} == want
    assert s.near_copies(df.limit(0)).collect() == [] and s.without_near_copies(df.limit(0)).collect() == []
    assert df.select(F.count("*")).first()[0] == len(rows)
