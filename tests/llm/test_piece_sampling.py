"""Sampled segmentations: exact chances, lossless, reproducible."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tierstone.llm import piece_sampling as s

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a  b ", "Hello wörld ▁x ▁▁\n\ty 漢字😀", "x" * 5000, "\x00� ", "the cat " * 50, "ñandú\r\n"]


@pytest.fixture(scope="module")
def table():
    return s.PieceTable(PATH)


def all_ways(table, word):
    ids = {table.pieces[i]: i for i in np.flatnonzero(table.weight < 0).tolist()}

    def ways(rest):
        if not rest:
            yield ()
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                for more in ways(rest[k:]):
                    yield (ids[rest[:k]], *more)

    return list(ways(word))


@pytest.mark.parametrize("sharpness", [1.0, 0.2])
def test_chances_are_those_of_the_lattice(table, sharpness):
    ways = all_ways(table, "▁hello")
    chance = np.exp(sharpness * np.array([table.weight[list(w)].sum() for w in ways]))
    chance /= chance.sum()
    n = 40_000
    got = Counter(tuple(x.tolist()) for x in s.encode_sampled(table, ["hello"] * n, np.arange(n).astype(np.uint64), sharpness))
    assert set(got) <= set(ways)
    for w, p in zip(ways, chance):
        assert abs(got[w] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_forward_sums_all_ways(table):
    word = "▁therein"
    lattice = s.Lattice(table, [word], 1.0)
    total = math.log(sum(math.exp(table.weight[list(w)].sum()) for w in all_ways(table, word)))
    assert lattice.ways[lattice.last[0]] == pytest.approx(total)


def test_lossless_and_independent_of_the_batch(table):
    keys = np.arange(len(TEXTS)).astype(np.uint64) * np.uint64(99)
    together = s.encode_sampled(table, TEXTS, keys)
    for i, text in enumerate(TEXTS):
        assert s.decode(table, together[i]) == text
        (alone,) = s.encode_sampled(table, [text], keys[i : i + 1])
        assert alone.tolist() == together[i].tolist()
    other = s.encode_sampled(table, TEXTS, keys + np.uint64(1))
    assert any(a.tolist() != b.tolist() for a, b in zip(together, other))


def test_columns(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "null key"), (6, TEXTS[6])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int")
    ids = s.sampled_ids(F.col("text"), F.col("doc_id"), PATH)
    got = df.select("doc_id", "text", ids.alias("x")).withColumn("back", s.decoded_text(F.col("x"), PATH))
    one = got.coalesce(1).collect()
    assert all(r.back == r.text for r in one) and one[-3].x is None
    assert one[6].x == one[-1].x
    many = {(r.doc_id, r.text): r.x for r in df.repartition(5).select("doc_id", "text", ids.alias("x")).collect()}
    assert many == {(r.doc_id, r.text): r.x for r in one}
    assert df.limit(0).select(ids).collect() == []
    whole = s.sampled_documents(df, PATH).collect()
    assert [(r.doc_id, r.text) for r in whole] == [(r.doc_id, r.text) for r in one]
    assert [r.ids for r in whole if r.doc_id is not None] == [r.x for r in one if r.doc_id is not None]
    assert s.sampled_documents(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("text", ["if  x", "   a", "a    ", " ▁ ", "▁▁  b"])
def test_runs_of_blanks_come_as_all_pieces_give_them(table, text):
    ids = {table.pieces[i]: i for i in np.flatnonzero(table.weight < 0).tolist()}
    assert "▁▁" in ids
    mark = [table.first_byte + b for b in "▁".encode()]

    def ways(rest):
        if not rest:
            yield (), 0.0
        elif rest[0] == "#":  # a mark of the text itself
            for more, w in ways(rest[1:]):
                yield (*mark, *more), w + 3 * s.BYTE_WEIGHT
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                for more, w in ways(rest[k:]):
                    yield (ids[rest[:k]], *more), w + table.weight[ids[rest[:k]]]

    sharpness, n = 0.3, 20_000
    chance = Counter()
    for way, w in ways("▁" + text.replace("▁", "#").replace(" ", "▁")):
        if "#" not in "".join(table.pieces[i] for i in way):
            chance[way] += math.exp(sharpness * w)
    total = sum(chance.values())
    got = Counter(tuple(x.tolist()) for x in s.encode_sampled(table, [text] * n, np.arange(n).astype(np.uint64), sharpness))
    assert set(got) <= set(chance)
    for way, c in chance.items():
        p = c / total
        assert abs(got[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 2e-4


def test_a_vocabulary_that_crosses_blanks_splits_nowhere(table, monkeypatch):
    assert table.parts("a  b ▁") == ["▁a", "▁▁b", "▁" + s.OWN_MARK]
    monkeypatch.setattr(table, "crossed", True)
    assert table.parts("a  b ") == ["▁a▁▁b▁"]
