"""Counts against brute force, Viterbi against all sequences, the field on held-out labels."""

import itertools
import random
import re
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierstone.llm import quality as q
from tierstone.llm.batches import WordHashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_rule(text):
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": len(covered), "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def test_counts():
    r = random.Random(0)
    texts = ["", " \n\t", "\x1c", "a\n\na\n a\na", "#é|<>&" * 3, "one two " * 20, "  x\u0085y"]
    texts += ["".join(r.choice("ab") + r.choice([" ", "\n", "\x0b"]) for _ in range(r.randrange(120))) for _ in range(60)]
    for text in texts:
        got = q.report(text, WordHashes(), None)
        assert {k: got[k] for k in by_rule(text)} == by_rule(text)
        assert got["kept"] is not got["base_failed"]


def test_viterbi_is_the_best_of_all_sequences():
    random_ = np.random.default_rng(1)
    for n in range(1, 8):
        field = q.LineField(random_.normal(size=(3, 2)), random_.normal(size=(2, 2)))
        x = random_.normal(size=(n, 3))

        def score(labels):
            e = sum(x[i] @ field.emit[:, y] for i, y in enumerate(labels))
            return e + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert field.label(x).tolist() == list(best)


def test_field_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chosen = labels.orderBy(F.xxhash64("doc_id")).limit(200)
    field = q.fit_line_field(docs, chosen)
    rest = docs.join(labels.join(chosen, "doc_id", "left_anti"), "doc_id")
    got = rest.select("quality", q.quality_of(F.col("text"), field).alias("r")).collect()
    clean = [r.r.kept for r in got if r.quality and not r.r.base_failed]
    bad = [r.r.kept for r in got if not r.quality]
    assert np.mean(clean) >= 0.97 and np.mean(bad) <= 0.1


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good line here.\n" * 3, 0), (2, None, 0), (3, "", 0), (None, "x", 0), (4, "w " * 100_000, 0)], "doc_id long, text string, kept int"
    )
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (9, 1), (None, 1), (3, None)], "doc_id long, quality int")
    field = q.fit_line_field(docs, labels)
    got = [r.r for r in docs.select(q.quality_of(F.col("text"), field).alias("r")).collect()]
    assert [r.n_words for r in got] == [9, 0, 0, 1, 100_000] and not any(r.kept for r in got)
    empty = q.fit_line_field(docs.limit(0), labels.limit(0))
    assert empty.label(np.ones((4, len(q.FEATURES)))).tolist() == [0] * 4
    assert docs.limit(0).select(q.quality_of(F.col("text"), empty)).collect() == []


@pytest.fixture(scope="module")
def halves():
    """Labelled documents in two halves, as features of their lines and label; few are bad, so a small table is too small."""
    sf = Path("/root/testdata/sf0.1")
    rows = pd.read_parquet(sf / "documents.parquet").merge(pd.read_parquet(sf / "labels.parquet"), on="doc_id")
    found = [(x, int(good <= 0)) for t, good in zip(rows.text, rows.quality) if len(x := q.line_features(t or "")[0])]
    return found[::2], found[1::2]


def test_splices_keep_lines_in_order():
    r = np.random.default_rng(3)
    for _ in range(300):
        good, bad = (np.arange(r.integers(1, 9))[:, None] + at for at in (0.0, 100.0))
        x, y = q.splice(good, bad, r)
        assert x[y == q.CONTENT].tolist() == good.tolist() and x[y == q.BOILERPLATE].tolist() == bad.tolist()


def test_transitions_help_on_held_out_splices(halves):
    seen, unseen = halves
    seen = seen[: q.SAMPLE]
    field = q.fit_field([(x[: q.SAMPLE_LINES], y) for x, y in seen])
    alone = q.LineField(field.emit, np.zeros((2, 2)))
    constant = q.fit_field([(x[: q.SAMPLE_LINES], y) for x, y in seen], splices=0)
    mixed = q.spliced(unseen, 300, seed=8)

    def right(f):
        return sum((f.label(x) == y).sum() for x, y in mixed) / sum(len(x) for x, _ in mixed)

    assert right(field) >= 0.92 and right(field) > right(alone) and right(field) > right(constant)
    documents = [((field.label(x) == q.CONTENT).mean() >= 0.5) == (y == 0) for x, y in unseen]
    assert np.mean(documents) >= 0.97


def test_share_of_a_mixed_document(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = q.fit_line_field(docs, labels)
    rows = docs.join(labels, "doc_id").where("text like '%\n%\n%\n%'").select("text", "quality").collect()
    good, bad = ([r.text for r in rows if (r.quality > 0) == kind] for kind in (True, False))
    texts = [(g + "\n" + b,) for g, b in zip(good, bad * len(good))][:60]
    shares = [r.s.content_share for r in spark.createDataFrame(texts, "text string").select(q.quality_of(F.col("text"), field).alias("s")).collect()]
    assert np.mean([0 < s < 1 for s in shares]) >= 0.9
    got = spark.createDataFrame([texts[0]] * 3, "text string").select(q.quality_of(F.col("text"), field).alias("s")).collect()
    assert len({r.s for r in got}) == 1
