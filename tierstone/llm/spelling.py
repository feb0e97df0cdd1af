"""Group spelling variants: words one edit apart, found through pivotal bigrams, hang on their more frequent form.

Bigrams have one order for the whole corpus, rarest first. A word's *prefix* is its three first bigrams in that order
(and all places of the third one); its *pivots* are two bigrams of the prefix that share no letter, chosen by dynamic
programming so that the words listed under them are fewest. One edit spoils at most one of two disjoint bigrams, so
of two words one edit apart the one whose prefix ends earlier in the order has a pivot that the other has, too, and
that lies in the other's prefix. Hence pivots are indexed and looked up by the prefixes of other words.

Position limits: the surviving pivot is intact and there is one edit, so either all letters before it are intact, and
it stands at the same distance from the start, or all behind it are, and it stands at the same distance from the end.
The index key is the pivot with the intact letters of its side. What meets there is verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import slices
from tierstone.sources.shared import cut_lineage

#: Words need this many code points (two disjoint bigrams always fit in the prefix then) and this many occurrences.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One of so many runs, by its checksum, has lost a letter.
SLIPS = 97
#: A form stands at least this many times as often as its word.
TIMES = 2
#: One edit spoils so many bigrams at most; with one more, some bigram of the prefix is left.
SPOILT = 2
#: Different words that a task counts before it sends them on.
KEPT_WORDS = 400_000
#: Pairs that a cell of the index may name before its words are told apart by the letters around the edit as well.
MOST_PAIRS = 10_000

#: ``[A-Za-z\\u00C0-\\u00FF]`` in lower-cased UTF-8.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def word_of(run: bytes, check: int) -> bytes | None:
    """The word of a lower-cased run, with ``check`` as its checksum; None if it is too short."""
    if check % SLIPS == 0:
        letters = run.decode()
        at = check % len(letters)
        run = (letters[:at] + letters[at + 1 :]).encode()
    if len(run) < LEAST_LETTERS or len(run) - run.count(b"\xc3") < LEAST_LETTERS:
        return None
    return run


_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def sent() -> pa.RecordBatch:
        words = pa.array([w.decode() for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], schema=_COUNTS)

    for part in slices(batches, "text"):
        for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            # the checksum of "<doc_id>:<run>" goes on from that of its start
            start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
            own: dict[bytes, int] = {}
            # only A to Z are lower-cased in bytes
            for run in _RUN.findall((text or "").encode().lower()):
                own[run] = own.get(run, 0) + 1
            for run, n in own.items():
                word = word_of(run, zlib.crc32(run, start))
                if word is not None:
                    counts[word] = counts.get(word, 0) + n
            if len(counts) >= KEPT_WORDS:
                yield sent()
                counts = {}
    yield sent()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words with enough letters and occurrences; counts are summed in each task first."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def bigram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """(place in the order, words listed) of each bigram, rarest first. There are at most 90 letters, so 8,100 bigrams."""
    starts = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    return {r.gram: (i, r.n) for i, r in enumerate(sorted(rows, key=lambda r: (r.n, r.gram)))}


def prefix_of(word: str, ranks: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """(rank, position) of the bigrams of the prefix, in the order."""
    grams = sorted((ranks[word[i : i + 2]][0], i) for i in range(len(word) - 1))
    last = grams[SPOILT][0]
    return [g for g in grams if g[0] <= last]


def pivots_of(prefix: list[tuple[int, int]], lists: dict[int, int], wanted: int = 2) -> list[tuple[int, int]]:
    """``wanted`` bigrams of the prefix that share no letter, with the fewest words listed under them.

    ``best[k]`` holds, walking along the word, the cheapest choice of k bigrams that end where the walk is; a bigram
    extends the best choice of one fewer that ends before it starts.
    """
    along = sorted((at, rank) for rank, at in prefix)
    ends: list[list[tuple[int, list[tuple[int, int]]]]] = [[(0, [])]]
    for i, (at, rank) in enumerate(along):
        before = next((j for j in range(i, 0, -1) if along[j - 1][0] + 2 <= at), 0)
        row = list(ends[i])
        for k, (cost, chosen) in enumerate(ends[before][:wanted]):
            taken = (cost + lists[rank], [*chosen, (rank, at)])
            if k + 1 == len(row):
                row.append(taken)
            elif taken[0] < row[k + 1][0]:
                row[k + 1] = taken
        ends.append(row)
    return ends[-1][wanted][1]


CELLS = "cell string, rest string, word string, last int, pivot boolean"
_CELLS = pa.schema([
    ("cell", pa.string()), ("rest", pa.string()), ("word", pa.string()), ("last", pa.int32()), ("pivot", pa.bool_()),
])


def _celled(ranks: dict[str, tuple[int, int]]):
    lists = dict(ranks.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                prefix = prefix_of(word, ranks)
                last = prefix[-1][0]
                for pivot, grams in ((True, pivots_of(prefix, lists)), (False, prefix)):
                    for _, at in grams:
                        # the place of the bigram is the length of its side: "<" up to its end, ">" from its start
                        out.append((f"<{at}<{word[: at + 2]}", word[at + 2 :], word, last, pivot))
                        out.append((f">{len(word) - at}>{word[at:]}", word[:at], word, last, pivot))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CELLS, strict=True)], schema=_CELLS)

    return run


def _variants(rest: Column) -> Column:
    """The letters beside the intact ones, whole and without each one of them: one edit leaves two words one in common."""
    places = F.sequence(F.lit(1), F.char_length(rest))
    less = F.transform(places, lambda i: F.concat(F.substring(rest, F.lit(1), i - 1), F.substring(rest, i + 1, F.char_length(rest))))
    return F.when(F.char_length(rest) == 0, F.array(rest)).otherwise(F.array_distinct(F.concat(F.array(rest), less)))


def near_words(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct words of ``words`` (column ``word``, stored) that are one edit apart.

    Cells that would name more than ``most_pairs`` pairs are joined on what is left of the word, too, whole or
    without one letter, so that a cell of very many words costs in proportion to them; no pair is left out.
    """
    cells = cut_lineage(words.select("word").mapInArrow(_celled(bigram_ranks(words)), CELLS))
    sizes = cells.groupBy("cell").agg(F.count_if("pivot").alias("entered"), F.count_if(~F.col("pivot")).alias("asking"))
    met = sizes.where((F.col("entered") > 0) & (F.col("asking") > 1))
    met = cut_lineage(met.select("cell", (F.col("entered") * F.col("asking") > most_pairs).alias("many")))
    kept = cells.join(met, "cell")
    told = F.when(F.col("many"), _variants(F.col("rest"))).otherwise(F.array(F.lit("")))
    keyed = kept.select("cell", F.explode(told).alias("told"), "word", "last", "pivot")
    entered = keyed.where("pivot").select("cell", "told", F.col("word").alias("a"), F.col("last").alias("a_last"))
    asking = keyed.where("NOT pivot").select("cell", "told", F.col("word").alias("b"), F.col("last").alias("b_last"))
    one_edit = (
        (F.col("a") != F.col("b")) & (F.col("a_last") <= F.col("b_last"))
        & (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = entered.join(asking, ["cell", "told"]).where(one_edit)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last one. A form's count is TIMES that of its word, so chains are short;
    each round doubles the steps taken."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = cut_lineage(stepped)
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are runs of Latin letters, A to Z lower-cased; of one run in SLIPS, by the checksum of id and run, one letter
    is left out, as a slip of the pen would. A word has LEAST_LETTERS code points and LEAST_COUNT occurrences in all
    texts. Near words differ by one inserted, deleted or replaced code point; a word's form is the most frequent of
    them (ties: the first in code-point order) if it stands TIMES as often, else null; root follows forms to the last.
    A null or empty text has no words, a null id is written as nothing; repeated rows count each; no words give no rows.
    """
    words = cut_lineage(word_counts(docs, id_col, text_col))
    pairs = cut_lineage(near_words(words, most_pairs))
    both = pairs.union(pairs.select("b", "a"))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    # the most frequent first; of equal ones the first in code-point order
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b"))).alias("best")
    near = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    has = F.coalesce(form_n >= TIMES * F.col("n"), F.lit(False))
    found = cut_lineage(found.select(
        "word", F.when(has, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, form_n).alias("form_n"),
    ))
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
