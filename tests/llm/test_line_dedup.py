"""Repeated and nearly repeated lines against brute force."""

import random
import time

import pytest

from tierstone.llm import line_dedup as d


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(r, line, edits):
    chars = list(line)
    for _ in range(edits):
        i = r.randrange(len(chars) + 1)
        kind = r.randrange(3)
        chars[i : i + (kind != 0)] = [] if kind == 1 else [r.choice("xyzé")]
    return "".join(chars)


def test_band_gives_the_distance():
    r = random.Random(1)
    for _ in range(4000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(14)))
        b = edited(r, a, r.randrange(5)) if a else "ab"
        for most in (1, 2, 3):
            assert d.within(a, b, most) == (distance(a, b) <= most)


def test_near_lines_share_a_cell():
    r = random.Random(2)
    for _ in range(3000):
        a = "".join(r.choice("ab ") for _ in range(r.randrange(8, 40)))
        b = edited(r, a, r.randrange(3))
        short, long = sorted((a, b), key=len)
        if min(len(a), len(b)) >= 3 and distance(a, b) <= 2:
            assert set(d.cells(short, 2)[0]) & set(d.cells(long, 2)[1])


def brute(docs):
    first = {}
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))
    rank = {doc: i for i, (doc, _) in enumerate(order)}
    for doc, text in order:
        for i, line in d.compared_lines(text or ""):
            first.setdefault(line, (rank[doc], i))
    lines = list(first)
    links, late = dict.fromkeys(lines, 0), set()
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= d.EDITS and distance(a, b) <= d.EDITS:
                links[a] += 1
                links[b] += 1
                late.add(max(a, b, key=first.get))
    out = {}
    for doc, text in docs:
        own = d.compared_lines(text or "")
        gone = [i for i, x in own if first[x] != (rank[doc], i) or x in late]
        kept = None if text is None else d.without_lines(text, gone)
        out[doc] = (len(own), len(gone), sum(links[x] for i, x in own if first[x] == (rank[doc], i)), kept)
    return out


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(7)
    base = ["".join(r.choice("abcdef  ") for _ in range(r.randrange(22, 60))) for _ in range(60)]
    docs = []
    for i in range(60):
        lines = [r.choice(base) if r.random() < 0.4 else edited(r, r.choice(base), r.randrange(1, 5)) for _ in range(r.randrange(6))]
        docs.append((i * 3, "\n".join([*lines, "short", ""] if r.random() < 0.5 else lines)))
    many = "".join(r.choice("ghijk ") for _ in range(40))
    docs += [(500 + i, edited(r, many, 1)) for i in range(25)] + [(900, None), (901, ""), (None, base[0]), (902, "  " + base[1] + " \r")]
    return docs


def test_equals_brute_force(spark, corpus):
    df = spark.createDataFrame([(*x, 0, True) for x in corpus], "doc_id long, text string, line int, first boolean").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_links, r.text) for r in d.without_repeated_lines(df).collect()}
    assert got == brute(corpus)
    cleaned = d.clean_lines(df)
    assert cleaned.columns == df.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {k: v[3] for k, v in got.items()}


def test_repeated_ids_and_empty_tables(spark):
    line = "a line that is long enough to be compared"
    df = spark.createDataFrame([(1, line), (1, line), (2, line + "\n" + line)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in d.without_repeated_lines(df).collect()) == [(1, 0), (1, 0), (2, 2)]
    assert d.without_repeated_lines(df.limit(0)).collect() == [] and d.clean_lines(df.limit(0)).collect() == []


def test_short_lines_go_if_they_are_equal(spark):
    rows = [(1, "Menu\nHome\n\n  Menu \n漢字"), (2, "home\nHome\n\n漢字\r\nHomes"), (3, "x" * 19), (4, "x" * 18 + "y\n" + "x" * 19 + "\n" + "x" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_links, r.text) for r in d.without_repeated_lines(df).collect()}
    assert got == {
        1: (4, 1, 0, "Menu\nHome\n\n漢字"), 2: (4, 2, 0, "home\n\nHomes"), 3: (1, 0, 0, "x" * 19),
        4: (3, 1, 0, "x" * 18 + "y\n" + "x" * 20),
    }


def test_refined_cells_give_the_same_links(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    texts = d.texts_by_id(df, "doc_id", "text")
    places = d.line_places(texts)

    def rows(most_pairs):
        return sorted((r.doc, r.line, r.links, r.earlier) for r in d.line_links(texts, places, most_pairs).collect())

    assert rows(0) == rows(20) == rows(10**9) != []


def test_pairs_meet_once_in_refined_cells():
    r = random.Random(9)
    for _ in range(3000):
        base = "".join(r.choice("ab") for _ in range(r.randrange(20, 34)))
        one, two = edited(r, base, r.randrange(2)), edited(r, base, r.randrange(3))
        short, long = sorted((one, two), key=len)
        if short == long or len(short) < d.LEAST_CHARS or distance(short, long) > d.EDITS:
            continue
        own = d._own_cells(short)
        cuts = [sorted(r.sample(range(1, len(short) - k), 2)) if r.random() < 0.7 else [] for _, _, k in own.values()]
        by_cell = dict(zip(own, cuts))
        entered = [{"cell": c, "role": d.ENTERED, "cuts": by_cell[c] or None} for c in own]
        looks = [{"cell": d._signed(c), "role": d.ASKED, "cuts": by_cell.get(d._signed(c)) or None} for c in d.cells(long, d.EDITS)[1]]
        left = {c for c, *_ in d._line_rows(1, 0, short, entered)}
        right = {c for c, *_ in d._line_rows(2, 0, long, looks)}
        first = d.first_cell(long, short, cuts, d.EDITS)
        assert first is not None and d._signed(first) in left & right


def test_lines_of_one_template(spark):
    r = random.Random(5)
    lines = list({f"Your order number {r.randrange(10**14):014d} has been sent to you today" for _ in range(20_000)})
    lines += [edited(r, x, 2) for x in lines[:200]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").repartition(8)
    start = time.perf_counter()
    got = {x.doc_id: x.n_links for x in d.without_repeated_lines(df).collect()}
    assert time.perf_counter() - start < 60
    near = [i for i in range(200) if lines[i] != lines[len(lines) - 200 + i]]
    assert all(got[i] and got[len(lines) - 200 + i] for i in near) and sum(map(bool, got.values())) < 3_000
