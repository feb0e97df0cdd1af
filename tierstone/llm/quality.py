"""Quality rules: counts over whole texts, and a linear-chain conditional random field over their lines.

The field labels each line of a document as content or boilerplate by features of the line and by the labels of its
neighbours; Viterbi decoding gives the likeliest sequence. A document is kept if its rules hold and if enough of its
words stand in content lines. The field is fitted by gradient ascent on the likelihood (forward and backward sums)
to a bounded sample of labelled documents: lines of good documents count as content, those of bad ones as boilerplate.
A document has one label, so its lines never change theirs; the field sees changes in documents spliced from runs of
lines of a good and a bad one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import WordHashes, gram_hashes, texts_of

#: Labelled documents that the field is fitted to, at most; those with the least hashes of their ids.
SAMPLE = 1_500
#: Lines of one document used for fitting, at most (labelling uses all); spliced documents for each sampled one.
SAMPLE_LINES, SPLICES = 40, 1
#: A document is kept from this share of its words in content lines on.
CONTENT_SHARE = 0.5
#: Words in a window for repeats, least words, most repeated words in a hundred.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "one", "few_words", "many_words", "word_length", "capitals", "symbols", "digits", "bars", "marks", "shouts",
    "repeated_words", "same_as_before", "no_end", "distinct",
)
CONTENT, BOILERPLATE = 0, 1
_ENDS = (".", "!", "?", ":", "…", '"', "»")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of features per line with a word, and the words of each."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = sum(map(len, words))
        symbols = sum(line.count(c) for c in "#*$%&|<>")
        last = line.rstrip()[-1:]
        kinds = len(set(words))
        rows.append((
            1.0, n < 4, n > 60, min(chars / n, 20) / 10,
            sum(map(str.isupper, words)) / n, min(symbols / n, 3.0), sum(map(str.isdigit, words)) / n,
            line.count("|") / n, (line.count(",") + line.count(".")) / n, line.count("!") / n,
            1 - kinds / n, line in seen, last not in _ENDS, min(kinds, 50) / 50,
        ))
        sizes.append(n)
        seen.add(line)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


@dataclass(frozen=True)
class LineField:
    """Weights per feature and label, and per pair of neighbouring labels."""

    emit: np.ndarray
    move: np.ndarray

    def label(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of a sequence of lines (Viterbi); of equal ones, content."""
        score = features @ self.emit
        n = len(score)
        if not n:
            return np.empty(0, np.int64)
        best, back = score[0], np.zeros((n, 2), np.int64)
        for t in range(1, n):
            way = best[:, None] + self.move
            back[t] = way.argmax(0)
            best = way.max(0) + score[t]
        out = np.empty(n, np.int64)
        out[-1] = int(best.argmax())
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


Sequence = tuple[np.ndarray, np.ndarray]


def splice(good: np.ndarray, bad: np.ndarray, random: np.random.Generator) -> Sequence:
    """Lines of both documents, each in its order, in two to five runs that alternate; with the label of each line."""
    runs: list[Sequence] = []
    n = int(random.integers(2, 6))
    first = int(random.integers(2))
    for kind, rows in ((CONTENT, good), (BOILERPLATE, bad)):
        own = [i for i in range(n) if (i + first) % 2 == kind]
        cuts = np.sort(random.choice(len(rows) - 1, min(len(own), len(rows)) - 1, replace=False)) + 1 if len(rows) > 1 else []
        runs += [(i, part, np.full(len(part), kind)) for i, part in zip(own, np.split(rows, cuts), strict=False)]
    runs.sort(key=lambda r: r[0])
    return np.concatenate([x for _, x, _ in runs]), np.concatenate([y for _, _, y in runs])


def spliced(sequences: list[tuple[np.ndarray, int]], count: int, seed: int = 5) -> list[Sequence]:
    """So many sequences spliced from a good and a bad document each; none if there are no documents of one kind.

    Stretches of long documents are taken, so that a splice is about as long as the longest sequence.
    """
    random = np.random.default_rng(seed)
    kinds = [[x for x, y in sequences if y == label and len(x)] for label in (CONTENT, BOILERPLATE)]
    if not all(kinds):
        return []
    most = max(len(x) for x, _ in sequences) // 2 + 1

    def stretch(rows: np.ndarray) -> np.ndarray:
        start = random.integers(max(1, len(rows) - most + 1))
        return rows[start : start + most]

    return [splice(*(stretch(kind[random.integers(len(kind))]) for kind in kinds), random) for _ in range(count)]


def fit_field(
    sequences: list[tuple[np.ndarray, int]], rounds: int = 100, rate: float = 0.2, decay: float = 1e-3, splices: int = SPLICES,
) -> LineField:
    """The field that makes the labels likeliest: each sequence is a document's lines' features and its label.

    Documents and their splices take part with equal weight, and so do both labels.
    """
    sequences = [(x, y) for x, y in sequences if len(x)]
    k = len(FEATURES)
    emit, move = np.zeros((k, 2)), np.eye(2)
    if not sequences:
        return LineField(emit, move)
    share = np.bincount([y for _, y in sequences], minlength=2) / len(sequences)
    whole = [(x, np.full(len(x), y)) for x, y in sequences]
    mixed = spliced(sequences, splices * len(sequences))
    weight = np.array([0.5 / share[y] for _, y in sequences] + [1 / max(splices, 1)] * len(mixed))
    sequences = whole + mixed
    n, longest = len(sequences), max(len(x) for x, _ in sequences)
    x, mask, labels = np.zeros((n, longest, k)), np.zeros((n, longest), bool), np.zeros((n, longest), np.int64)
    for i, (rows, own) in enumerate(sequences):
        x[i, : len(rows)], mask[i, : len(rows)], labels[i, : len(rows)] = rows, True, own
    weight = weight / mask.sum(1)
    same = np.eye(2)[labels]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:, :-1], labels[:, 1:]), weight[:, None] * mask[:, 1:])
    steps = [np.zeros_like(emit), np.zeros_like(move)]
    squares = [np.zeros_like(emit), np.zeros_like(move)]
    for turn in range(1, rounds + 1):
        score = x @ emit
        forward = np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            ways = forward[:, t - 1, :, None] + move
            new = np.logaddexp(ways[:, 0], ways[:, 1]) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        backward = np.zeros_like(score)
        pairs = np.zeros((2, 2))
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            ahead = move + (score[:, t + 1] + backward[:, t + 1])[:, None, :]
            backward[:, t] = np.where(mask[:, t + 1, None], np.logaddexp(ahead[..., 0], ahead[..., 1]), 0)
            both = np.exp(np.minimum(forward[:, t, :, None] + ahead - total[:, None, None], 0))
            pairs += np.tensordot(weight * mask[:, t + 1], both, 1)
        odds = np.exp(np.minimum(forward + backward - total[:, None, None], 0)) * (weight[:, None] * mask)[..., None]
        wanted = same * (weight[:, None] * mask)[..., None]
        slopes = [
            np.einsum("ntk,ntl->kl", x, wanted - odds) / n - decay * emit, (seen - pairs) / n - decay * move,
        ]
        for i, value in enumerate((emit, move)):
            steps[i] = 0.9 * steps[i] + 0.1 * slopes[i]
            squares[i] = 0.99 * squares[i] + 0.01 * slopes[i] ** 2
            value += rate * (steps[i] / (1 - 0.9**turn)) / (np.sqrt(squares[i] / (1 - 0.99**turn)) + 1e-8)
    return LineField(emit, move)


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, size: int) -> DataFrame:
    """Texts with a label: the ``size`` labelled rows whose ids have the least hashes."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), (F.col(label_col) > 0).alias("good")
    )
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "good").limit(size)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "_id")


def fit_line_field(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES, splices: int = SPLICES,
) -> LineField:
    """The field fitted to at most ``sample`` labelled documents, the first ``sample_lines`` lines of each, and to
    ``splices`` spliced ones for each of them.

    Labels without a document, null labels and null ids play no part; several labels of a document all count.
    Without any labelled document the field calls every line content.
    """
    def features(column: pa.Array) -> pa.Array:
        return pa.array([line_features(x)[0][:sample_lines].ravel().tolist() for x in texts_of(column)], pa.list_(pa.float64()))

    rows = _sampled(docs, labels, id_col, text_col, label_col, sample).select(
        "_id", "good", F.arrow_udf(features, "array<double>")(F.col("text")).alias("x")
    )
    found = rows.orderBy(F.xxhash64("_id"), "_id", "good", "x").limit(sample).collect()
    rows = [(np.array(r["x"]).reshape(-1, len(FEATURES)), CONTENT if r["good"] else BOILERPLATE) for r in found]
    return fit_field(rows, splices=splices)


REPORT = (
    "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,"
    "kept:boolean,content_share:double>"
)
_REPORT = pa.struct([
    *[(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64()),
])
_BLANKS = b" \t\n\r\x0b\x0c"
_LEAD = bytes(x for x in range(0x80, 0xC0))


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows whose words stand in order twice or more in the sequence."""
    grams = gram_hashes(hashes, window)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, np.flatnonzero(twice), 1)
    np.add.at(steps, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def report(text: str, hashes: WordHashes, field: LineField | None) -> dict:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = Counter(x for x in raw.split(b"\n") if x and not x.isspace())
    repeated = repeated_words(hashes.of(words))
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    share = None
    if field is not None:
        features, sizes = line_features(text)
        share = float(sizes[field.label(features) == CONTENT].sum() / max(sizes.sum(), 1))
    return {
        "n_words": n, "word_chars": len(raw.translate(None, _BLANKS + _LEAD)),
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": sum(lines.values()) - len(lines), "n_repeat_words": repeated, "base_failed": failed,
        "kept": not failed and (share is None or share >= CONTENT_SHARE), "content_share": share,
    }


def quality_of(text: Column, field: LineField | None) -> Column:
    """The rules' counts and the verdict on a text, as a struct; without a field the rules decide alone.

    A null or empty text has no words and fails the rules. Lines without a word take no label. Very long texts are
    read whole, repeated rows get equal verdicts. Ties between labels go to content.
    """
    def judge(column: pa.Array) -> pa.Array:
        hashes = WordHashes()
        return pa.array([report(x, hashes, field) for x in texts_of(column)], _REPORT)

    return F.arrow_udf(judge, REPORT)(text)
