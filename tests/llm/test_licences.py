"""Licence phrases and templates."""

import re

import pytest
from pyspark.sql import functions as F

from tierstone.llm import licences as l


def by_rule(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def labels(text):
    return {x for _, _, x in l.template_matches(l.words_of(text), l._automata(l.TEMPLATES))}


def test_words_and_base():
    text = "The MIT-License, mit license; MIT  license!\nÉß Apache\tLICENSE x General Public License\x7fÀ1"
    words = l.words_of(text)
    assert words == by_rule(text)
    joined = " ".join(w.decode() for w in words).split()
    want = sorted(
        (i, label) for label, p in l.PHRASES.items() for i in range(len(joined)) if joined[i : i + len(p.split())] == p.split()
    )
    assert [(a, x) for a, _, x in l.base_places(words)] == want and len(want) == 5


def test_optional_and_replaceable_regions():
    a = l.compile_template("x", 'may <<beginOptional>>or may not <<endOptional>>be used by <<var;name="who";original="me";match=".{1,3}">> freely')
    run = lambda text: a.longest(text.encode().split(), 0)
    assert run("may be used by me freely") == 6
    assert run("may or may not be used by all of us freely now") == 11
    assert run("may or not be used by me freely") == -1
    assert run("may be used by freely") == -1 and run("may be used by a b c d freely") == -1
    assert run("may be used by me") == -1
    with pytest.raises(ValueError):
        l.compile_template("x", "<<beginOptional>>open")
    with pytest.raises(ValueError):
        l.compile_template("x", "<<unknown>>")


def test_notices():
    assert labels("Released under the MIT License.") == {"mit"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl"}
    assert labels("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not") == {"apache"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc"}
    assert labels("Released under another License. A license to kill; permission is granted.") == set()
    altered = dict(l.TEMPLATES)["isc"].replace("without", "with little")
    assert labels(dict(l.TEMPLATES)["isc"]) == {"isc"} and labels(altered) == set()


def test_columns(spark):
    rows = [(1, "x Released under the MIT License"), (2, None), (3, ""), (4, "word " * 200_000 + "apache license"), (1, "mit license")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, labels int")
    got = [r.r for r in df.select(l.licences_in(F.col("text")).alias("r")).collect()]
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got] == [
        (6, 1, 4, 4, "mit", "mit"), (0, 0, None, None, "", ""), (0, 0, None, None, "", ""),
        (200_002, 1, 200_000, 200_000, "apache", "apache"), (2, 1, 0, 0, "mit", "mit"),
    ]
    assert all(0 <= r.score <= 1 for r in got) and got[4].score == 1.0
    assert df.limit(0).select(l.licences_in(F.col("text"))).collect() == []
