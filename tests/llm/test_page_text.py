"""Blocks of broken markup, gradients, and the labeller on unseen pages."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierstone.llm import page_text as p


def test_blocks():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><script>var t='</p>';</script>"
        "<nav><ul><li><a href='/x'>Home</a><li>Two</ul></nav><!-- <p>no</p> --><article><h1>A &amp; B</h1>"
        "<p><b>one\n two<br><p>three <i>four</i>&nbsp;5 < 6</p>tail</article><footer>&copy; x</footer>"
    )
    got = [(b.text, b.path[-1]) for b in p.blocks_of(page)]
    assert got == [
        ("Home", "<a>"), ("Two", "<li>"), ("A & B", "<h1>"), ("one two", "<b>"), ("three four 5 < 6", "<p>"),
        ("tail", "<article>"), ("© x", "<footer>"),
    ] or [t for t, _ in got] == ["Home", "Two", "A & B", "one two", "three four 5 < 6", "tail", "© x"]
    assert p.blocks_of("") == [] and p.blocks_of("<script>never closed") == []
    assert [b.text for b in p.blocks_of("no markup at all")] == ["no markup at all"]


def test_slopes_are_those_of_the_loss():
    random = np.random.default_rng(0)
    d = p.Direction(random.normal(size=(5, 12)), random.normal(size=(3, 12)), random.normal(size=12))
    x, mask, weight = random.normal(size=(2, 4, 5)), np.array([[1, 1, 1, 1], [1, 1, 0, 0.0]]), random.normal(size=(2, 4, 3))
    trace = []
    d.run(x, mask, trace)
    slopes = d.slopes(x, trace, weight)
    for values, slope in zip((d.w, d.u, d.b), slopes):
        for at in (0, values.size // 2, values.size - 1):
            flat = values.reshape(-1)
            old, step = flat[at], 1e-6
            flat[at] = old + step
            up = (d.run(x, mask) * weight).sum()
            flat[at] = old - step
            down = (d.run(x, mask) * weight).sum()
            flat[at] = old
            assert (up - down) / (2 * step) == pytest.approx(slope.reshape(-1)[at], abs=1e-5)


@pytest.fixture(scope="module")
def labeller(spark):
    return p.fit_labeller(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), sample=90)


def test_unseen_pages(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", p.main_text(F.col("html"), labeller).alias("text")).collect()
    want = ["\n".join(b.text for b in p.blocks_of(r.html) if p.by_landmarks(b)) for r in rows]
    assert np.mean([r.text == w for r, w in zip(rows, want)]) >= 0.99


def test_other_layouts(labeller, spark):
    random, describer = np.random.default_rng(99), p.Describer()
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy(F.xxhash64("page_id").desc()).limit(80).collect()
    right = total = 0
    for r in pages:
        labelled = p.altered(p.blocks_of(r.html), random)
        (keep,) = labeller.keep([describer.rows([b for b, _ in labelled])])
        right += int((keep == np.array([y for _, y in labelled])).sum())
        total += len(labelled)
    assert right >= 0.97 * total


def test_odd_rows(spark, labeller):
    long = "<article>" + "<p>A paragraph of some words, as they stand in articles.</p>" * 3000 + "</article>"
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, long, 1), (None, "<nav><a href=x>menu</a></nav>", 1)], "page_id long, html string, text int")
    got = [r.t for r in df.select(p.main_text(F.col("html"), labeller).alias("t")).collect()]
    assert got[:2] == ["", ""] and got[2].count("\n") == 2999
    assert df.limit(0).select(p.main_text(F.col("html"), labeller)).collect() == []
    untrained = p.fit_labeller(df.limit(0))
    assert isinstance(untrained, p.BlockLabeller)


def test_all_words_of_a_block_count():
    low = 2 * p.PATH_SIZE
    words = [f"word{i % 7}" for i in range(300)]
    (row,) = p.Describer().rows([p.Block(" ".join(words), (), 0)])
    want = np.zeros(p.WORD_SIZE)
    for w in words:
        want[p._slot(w, p.WORD_SIZE)] += 1 / 300**0.5
    assert row[low : low + p.WORD_SIZE] == pytest.approx(want)
    (other,) = p.Describer().rows([p.Block(" ".join([*words[:200], *["advert"] * 100]), (), 0)])
    assert (row[low : low + p.WORD_SIZE] != other[low : low + p.WORD_SIZE]).any()


def test_what_is_no_drawing_stays():
    def texts(page):
        return [b.text for b in p.blocks_of(page)]

    assert texts("<p>a<svg viewBox='0 0 1 1'/>b</p><p>c</p>") == ["a b", "c"]
    assert texts("<p>a<svg-icon name=x></svg-icon>b</p><p>c</p>") == ["a", "b", "c"]
    assert texts("<template-x>a</template-x><p>b</p>") == ["a", "b"]
    assert texts("<p>a<svg><title>t</title><svg><text>x</text></svg><text>y</text></svg>b</p>") == ["a b"]
    assert texts("<p>a<svg><path d='M0'><text>x</text><p>b</p><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a<svg><foreignObject><div>x</div></foreignObject><text>y</text></svg>b</p>") == ["a b"]
    assert texts("<p>a</p><svg><path d='a>b'/></svg><p>b</p>") == ["a", "b"]


def test_formulas_are_inline_text():
    page = "<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, <math/>so.</p><p>End.</p>"
    assert [b.text for b in p.blocks_of(page)] == ["As x=2 holds, so.", "End."]
    page = "<p><math><semantics><mi>y</mi><annotation encoding='TeX'>y_{1}</annotation></semantics></math></p>"
    assert [b.text for b in p.blocks_of(page)] == ["y"]


def test_head_without_its_tags():
    head = "<head><meta charset=utf-8><title>T</title><link rel=x href=y><style>p{}</style><script>s</script>\n"
    for rest in ("<p>a</p><p>b</p>", "<article><p>a</p><p>b</p></article>", "</head><p>a</p><p>b</p>", "<body><p>a</p><p>b</p>", "a<p>b</p>"):
        assert [b.text for b in p.blocks_of("<html>" + head + rest)] == ["a", "b"]
    assert p.blocks_of(head) == []


#: The rule of tokens_of as one pattern, which takes quadratic time on markup that never ends.
PLAIN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>",
    re.S | re.I,
)


def test_tokens_against_one_pattern():
    r = random.Random(4)
    parts = [
        "<", "</", ">", "/>", "\"", "'", "=", " ", "\n", "a", "P", "x<y", "<p", "<a ", "<!--", "-->", "<!", "<?", "<script>",
        "</SCRIPT >", "<style", "</style>", "<title/", "<li class=\"", "<b id='", "</p>", "<div>",
    ]
    for _ in range(20_000):
        page = "".join(r.choices(parts, k=r.randrange(25)))
        want = [
            (m.start(), m.end(), (m["tag"] or "").lower(), bool(m["end"]), m["rest"] or "", bool(m["raw"])) for m in PLAIN.finditer(page)
        ]
        got = [(t.start, t.end, t.tag, t.closing, t.rest, t.raw) for t in p.tokens_of(page)]
        assert got == want, page


@pytest.mark.parametrize("part", [
    '<p class="x', "<a ", "<a", "<p class='x\" ", "<script", "<!", "<b>x", "<div>x", "<i>x</b>", "</", "<!--", "<li>x", "&amp", "<svg>", "<br",
    "<script>x</script ", "'\"<p ",
])
def test_broken_markup_takes_time_in_proportion(part):
    page = "<b><div>" + part * (1_000_000 // len(part))
    start = time.perf_counter()
    p.blocks_of(page)
    assert time.perf_counter() - start < 8
