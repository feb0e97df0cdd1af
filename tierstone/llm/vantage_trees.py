"""Nearest neighbours by cosine: vantage-point trees per shard, searched by blocks of queries.

Rows are dealt to shards by a hash of their ids, so shards are of one size whatever the vectors look like. A shard's
tree splits its distinct vectors by their angle to a vantage point; angles obey the triangle inequality, so a subtree
whose angles to the vantage point lie further from the query's than the worst of its k best so far holds nothing
better. ``factor`` stretches that gap: 1 is exact search, more visits fewer subtrees. All queries of a block walk
the tree together, so each visit is one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows in a shard and queries in a block, about; a task holds one of each.
SHARD_ROWS, BLOCK_QUERIES = 8_192, 20_000
#: Distinct vectors in a leaf.
LEAF = 48
#: Stretches the gap in the triangle inequality; see the README for the recall it gives.
FACTOR = 1.2
#: Angles are compared with so much slack, for their rounding.
SLACK = 1e-6
#: More neighbours are kept during the search, so that it opens more leaves.
SPARE = 3
#: Candidates whose exact scores are computed together, and that are held before each query keeps its k best of them.
AT_ONCE, HELD = 50_000, 500_000


@dataclass
class Node:
    """Members are [first, end) of the tree's order; a leaf has no children."""

    first: int
    end: int
    point: int = -1
    inside: tuple[float, float, Node] | None = None
    outside: tuple[float, float, Node] | None = None


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class VantageTree:
    """A tree over unit vectors."""

    def __init__(self, unit: np.ndarray, seed: int = 0):
        self.unit = unit
        self.order = np.arange(len(unit))
        self.random = np.random.default_rng(seed)
        self.root = Node(0, len(unit))
        todo = [self.root]
        while todo:
            todo.extend(self._split(todo.pop()))
        self.sorted = unit[self.order]

    def _split(self, node: Node) -> list[Node]:
        if node.end - node.first <= LEAF:
            return []
        members = self.order[node.first : node.end]
        tries = self.random.choice(members, 5)
        sample = self.unit[self.random.choice(members, min(100, len(members)))]
        node.point = int(tries[np.argmax(angles(self.unit[tries] @ sample.T).std(1))])
        far = angles(self.unit[members] @ self.unit[node.point])
        by = np.argsort(far, kind="stable")
        far, self.order[node.first : node.end] = far[by], members[by]
        half = len(by) // 2
        middle = node.first + half
        inner, outer = Node(node.first, middle), Node(middle, node.end)
        node.inside = float(far[0]), float(far[half - 1]), inner
        node.outside = float(far[half]), float(far[-1]), outer
        return [inner, outer]

    def nearest(self, queries: np.ndarray, k: int, factor: float) -> tuple[list[tuple[Node, np.ndarray]], np.ndarray]:
        """Leaves opened, each with the unit queries that opened it, and the k best cosines of each query, best first."""
        n = len(queries)
        best = np.full((n, k), -np.inf)
        opened: list[tuple[Node, np.ndarray]] = []
        home = np.full(n, -1)

        def look(node: Node, who: np.ndarray) -> None:
            cosines = np.concatenate([best[who], queries[who] @ self.sorted[node.first : node.end].T], axis=1)
            best[who] = -np.partition(-cosines, k - 1, axis=1)[:, :k]
            opened.append((node, who))

        todo = [(self.root, np.arange(n))]
        while todo:
            node, who = todo.pop()
            if node.point < 0:
                look(node, who)
                home[who] = node.first
                continue
            near = angles(queries[who] @ self.unit[node.point]) <= (node.inside[1] + node.outside[0]) / 2
            todo += [(child, w) for child, w in ((node.inside[2], who[near]), (node.outside[2], who[~near])) if len(w)]
        todo = [(self.root, np.arange(n))]
        while todo:
            node, who = todo.pop()
            if node.point < 0:
                who = who[home[who] != node.first]
                if len(who):
                    look(node, who)
                continue
            away = angles(queries[who] @ self.unit[node.point])
            for low, high, child in (node.outside, node.inside):
                gap = np.maximum(np.maximum(low - away, away - high), 0)
                worst = np.where(np.isneginf(best[who].min(1)), np.inf, angles(best[who].min(1)))
                open_ = who[gap * factor <= worst + SLACK]
                if len(open_):
                    todo.append((child, open_))
        return opened, -np.sort(-best, axis=1)

    def reached(
        self, queries: np.ndarray, opened: list[tuple[Node, np.ndarray]], least: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, position) of all vectors of the opened leaves whose cosine is the query's ``least`` or more."""
        for node, who in opened:
            cosines = queries[who] @ self.sorted[node.first : node.end].T
            row, place = np.nonzero(cosines >= least[who, None])
            yield who[row], self.order[node.first + place]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks).flatten() if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component is near 1: no square is too large or too small.

    Such a factor is exact and leaves every cosine as it is, bit by bit.
    """
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision and in the same way for each."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, cosine): for each query the k nearest rows found in one shard, or all if there are fewer.

    Equal vectors are one point of the tree; their rows are listed by id, and all with the same cosine. Points whose
    cosine reaches that of the k-th are all candidates, however many share it, so that exact scores and ids settle ties.
    """
    vectors, queries = _scaled(vectors), _scaled(queries)
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    new = np.ones(len(ids), bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(1)
    again = ~new
    again[1:] &= ids[1:] == ids[:-1]
    ids, vectors, new = ids[~again], vectors[~again], new[~again]
    firsts = np.flatnonzero(new)
    ends = np.append(firsts[1:], len(ids))
    points = vectors[firsts]
    tree = VantageTree(points / np.linalg.norm(points, axis=1)[:, None])
    unit = queries / np.linalg.norm(queries, axis=1)[:, None]
    # one of the points may hold the query's own row only
    opened, best = tree.nearest(unit, min(k + SPARE, len(points)), factor)
    least = best[:, min(k, best.shape[1] - 1)] - SLACK

    def first(who: np.ndarray, near: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((near, -score, who))
        who, near, score = who[order], near[order], score[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        return who[keep], near[keep], score[keep]

    def rows(who: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score = _exact(queries[who], points[place])
        sizes = np.minimum(ends[place] - firsts[place], k + 1)
        row = np.repeat(firsts[place], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        who, score, near = np.repeat(who, sizes), np.repeat(score, sizes), ids[row]
        other = query_ids[who] != near
        return who[other], near[other], score[other]

    held = [(np.empty(0, np.int64), ids[:0], np.empty(0))]
    size = 0
    for who, place in tree.reached(unit, opened, least):
        for at in range(0, len(who), AT_ONCE):
            held.append(rows(who[at : at + AT_ONCE], place[at : at + AT_ONCE]))
            size += len(held[-1][0])
            if size > HELD:
                held, size = [first(*map(np.concatenate, zip(*held, strict=True)))], 0
    who, near, score = first(*map(np.concatenate, zip(*held, strict=True)))
    return query_ids[who], near, score


def _usable(vector: Column) -> Column:
    """Has components, all of them finite, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
    factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of largest cosine found, ties to the smaller id.

    A query is a row of ``queries`` with the same columns; rows with its id are no candidates. Vectors that are null,
    empty or zero, or hold a null or a value that is not finite, and rows without an id take no part. Vectors are
    compared with those of the same length only. A row that repeats with the same vector counts once; a query id that
    repeats stands for its least vector. Without candidates a query has no rows. Extra columns play no part.
    """
    def shown(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return own.where(F.col("id").isNotNull() & _usable(F.col("vector"))).withColumn("dim", F.size("vector"))

    rows = shown(vectors)
    asked = shown(queries).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    n, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_asked // BLOCK_QUERIES))
    number = F.xxhash64("id")
    dealt = rows.select(
        "dim", F.pmod(number, F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "id", "vector",
    )
    sent = asked.select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(number, F.lit(blocks)).cast("int").alias("block"), "id", "vector",
    )

    def search(key: tuple, shard: pa.Table, block: pa.Table) -> pa.Table:
        if not shard.num_rows or not block.num_rows:
            return _FOUND.empty_table()
        dim = key[0].as_py()
        found = search_shard(
            shard.column("id").to_numpy(), _matrix(shard.column("vector"), dim),
            block.column("id").to_numpy(), _matrix(block.column("vector"), dim), k, factor,
        )
        return pa.table([pa.array(x) for x in found], schema=_FOUND)

    keys = ("dim", "shard", "block")
    found = dealt.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
