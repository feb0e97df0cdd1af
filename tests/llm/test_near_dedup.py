"""Near copies by similarity of five-word runs, against brute force."""

import random

import numpy as np

from tierstone.llm import near_dedup as s


def sets(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(docs):
    left, out = dict(docs), set()
    while left:
        first = min(left)
        todo = group = {first}
        while todo:
            near = set()
            for i in left:
                a = sets(left[i])
                if i not in group and any(5 * len(a & sets(left[j])) >= 4 * len(a | sets(left[j])) for j in todo):
                    near.add(i)
            group, todo = group | near, near
        out.add(first)
        left = {i: t for i, t in left.items() if i not in group}
    return out


def test_equals_brute_force(spark):
    r = random.Random(3)
    docs = {}
    for g in range(25):
        words = [f"w{r.randrange(5000)}" for _ in range(r.randrange(1, 300))]
        for _ in range(r.randrange(1, 7)):
            docs[len(docs)] = " ".join(words)
            words = list(words)
            for _ in range(r.randrange(0, 1 + len(words) // 40)):
                words[r.randrange(len(words))] = "other" + str(r.randrange(99))
    docs |= {900: "", 901: None, 902: " \n", 903: docs[0].upper(), 904: "a b", 905: "a  b"}
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, cell string").repartition(4)
    got = s.without_near_copies(df)
    assert got.columns == df.columns
    assert {x.doc_id for x in got.collect()} == kept(docs)
    assert s.without_near_copies(df.limit(0)).collect() == []


def test_stage_drops_copies_of_the_least_similarity(spark):
    """Three changed words of 200 leave a similarity of about 0.86, three of 140 one of just over 0.8."""
    from corpus_pipeline import near_dedup

    r = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"v{r.randrange(4000)}" for _ in range(140 if i % 2 else 200)]
        rows.append((2 * i, " ".join(words)))
        for at in (20, 70, 120):
            words[at] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {x.doc_id for x in near_dedup(spark, df, "").collect()}
    assert left >= set(range(0, 120, 2)) and len(left) <= 63


def test_a_group_of_near_copies_gives_few_pairs(spark):
    """Copies of one text with a few words of their own: every pair meets, but few are looked at."""
    r = random.Random(6)
    base = [f"v{r.randrange(4000)}" for _ in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in r.sample(range(150), 2):
            words[at] = f"own{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in s.without_near_copies(df).collect()} == kept(rows)


def test_tables_grow_with_the_corpus():
    few, many = s.Tables(10**5), s.Tables(10**9)
    assert (few.bits, many.bits) == (20, 32) and many.segments > few.segments


def test_cells_hold_all_that_differ_by_one_bit_a_segment():
    r = random.Random(7)
    tables = s.Tables(1000)
    for _ in range(30):
        bits = [r.getrandbits(1) for _ in range(tables.words * 64)]
        a = np.packbits(bits, bitorder="little").view(np.uint64)
        for segment in range(tables.segments):
            bits[segment * tables.bits + r.randrange(tables.bits)] ^= 1
        b = np.packbits(bits, bitorder="little").view(np.uint64)
        common = set((s.cells_of(a, tables) >> np.uint64(tables.bits)).tolist()) & set((s.cells_of(b, tables) >> np.uint64(tables.bits)).tolist())
        shared = set(s.cells_of(a, tables).tolist()) & set(s.cells_of(b, tables).tolist())
        assert common == set(range(tables.segments)) == {c >> tables.bits for c in shared}


def test_recall_at_the_least_similarity():
    """Pairs of a similarity of 0.8 to 0.81 share a cell at least as often as RECALL promises, less three deviations."""
    r = random.Random(8)
    words, tables = s.WordHashes(), s.Tables(10**5)
    met = 0
    for _ in range(400):
        common = [f"c{r.randrange(10**9)}" for _ in range(160)]
        a, b = (s.shingles(" ".join(common + [f"{x}{r.randrange(10**9)}" for _ in range(20)]), words, 1) for x in "ab")
        assert s.similar(a, b, 80) and not s.similar(a, b, 82)
        cells = (set(s.cells_of(s.fingerprint(x, tables.words), tables).tolist()) for x in (a, b))
        met += bool(set.intersection(*cells))
    assert met >= 400 * s.RECALL - 3 * (400 * s.RECALL * (1 - s.RECALL)) ** 0.5
