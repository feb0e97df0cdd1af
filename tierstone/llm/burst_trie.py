"""The prefix trie of conversations, built as a burst trie over shards.

Every conversation is a sequence of turn ids. Equal sequences are one, with the conversations that it ends. All
sequences start in one *container* under the root. A container with too many turns in it bursts: the node it hangs on
becomes part of the trie's *head*, and its sequences go, by their next turn id, to containers of the nodes below; where
all of them go on alike for a while, the whole stretch is taken at once. Only sizes are counted for this, one round
for all containers that burst together, and no sequence is moved.

What is left are containers that fit a task. They are dealt over the shards, sorted and swept: the common prefix of a
sequence and the one before tells which nodes end and which begin. The nodes of the head get the sums of the
containers below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.sources.shared import cut_lineage

#: Turns that the sequences of a container have together at most (a single longer sequence fills one alone).
MOST_TURNS = 200_000
#: A conversation starts with turns of the first of its block of so many ids, fewer than SHARED of them.
BLOCK, SHARED = 20, 4
#: Ids of a sequence whose decimals are joined in one task.
ID_RANGE = 4_096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

#: (id of role and text, words of the text)
TURN = "struct<id: binary, words: long>"


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turns): the turns of each conversation in order."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    # the length keeps apart where the role ends and the text begins
    own = F.unhex(F.md5(F.concat_ws(" ", F.char_length(who).cast("string"), who, said)))
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.struct(F.col(turn).alias("turn"), who.alias("role"), own.alias("id"), words.alias("words")).alias("t")
    )
    # nulls sort first within a struct
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): each conversation with its first turns taken from the first one of its block."""
    own = cut_lineage(_turns(conversations, conv, turn, role, text))
    first = own.where(F.col("conv") % BLOCK == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, SHARED - 1).alias("start"))
    taken = (F.crc32(F.col("conv").cast("string")) % SHARED).cast("int")
    joined = own.withColumn("base", F.col("conv") - F.col("conv") % BLOCK).join(first, "base", "left").withColumn("taken", taken)
    start = F.slice(F.coalesce("start", F.array().cast(f"array<{TURN}>")), F.lit(1), F.col("taken"))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv", F.concat(start, rest).alias("turns"))


_ENDS = pa.schema([("sequence", pa.binary()), ("ends_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The checksum of each sequence's ids; rows (sequence, part, ids) come sorted, the ids of a part joined already."""
    name, digest = None, None
    for batch in batches:
        done = []
        for sequence, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if sequence != name:
                if digest is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = sequence, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _ENDS, strict=True)], schema=_ENDS)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], schema=_ENDS)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(sequence, ids, words, n, first, ends_sha256): each sequence once, with the conversations that are it.

    The ids of a sequence are joined range by range, so that the one task that a checksum needs reads few rows.
    """
    ids = F.transform("turns", lambda t: t["id"])
    name = F.unhex(F.sha2(F.concat(F.lit("s").cast("binary"), F.array_join(F.transform(ids, F.hex), "").cast("binary")), 256))
    named = cut_lineage(convs.select(name.alias("sequence"), "conv", "turns"))
    # what stands for a sequence is any of its conversations: equal ids have equal words
    one = named.groupBy("sequence").agg(F.count("*").alias("n"), F.min("conv").alias("first"))
    turns = named.join(one.select("sequence", F.col("first").alias("conv")), ["sequence", "conv"], "left_semi")
    parts = named.groupBy("sequence", F.floor(F.col("conv") / ID_RANGE).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    hashes = parts.repartition("sequence").sortWithinPartitions("sequence", "part").mapInArrow(_hashed, "sequence binary, ends_sha256 string")
    return turns.join(one, "sequence").join(hashes, "sequence").select(
        "sequence", F.transform("turns", lambda t: t["id"]).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"),
        "n", "first", "ends_sha256",
    )


def _head(depth: Column) -> Column:
    """The name of the node that the first ``depth`` turns of a sequence lead to."""
    return F.unhex(F.md5(F.concat(depth.cast("string").cast("binary"), F.array_join(F.transform(F.slice("ids", F.lit(1), depth), F.hex), "").cast("binary"))))


def containers(sequences: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """``sequences`` with ``top`` (the node that its container hangs on) and ``depth`` (of that node); stored.

    Each round bursts all containers that are too large, behind the turns that all their sequences share. A sequence
    that ends where its container bursts stays there: ``ended`` is true and its top is a node of the head.
    """
    now = sequences.select("*", F.lit(0).alias("depth"), F.lit(False).alias("ended")).withColumn("top", _head(F.col("depth")))
    done = None
    now = cut_lineage(now)
    while True:
        # the least and the greatest sequence share what all of a container share
        sizes = now.where("NOT ended").groupBy("top").agg(
            F.sum(F.size("ids") - F.col("depth") + 1).alias("turns"), F.count("*").alias("members"), F.min("ids").alias("low"), F.max("ids").alias("high")
        )
        large = sizes.where((F.col("turns") > most_turns) & (F.col("members") > 1))
        same = F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b) & a.isNotNull())
        shared = F.array_position(same, F.lit(False)) - 1
        large = large.select("top", F.when(shared < 0, F.least(F.size("low"), F.size("high"))).otherwise(shared).cast("int").alias("shared"))
        large = cut_lineage(large)
        if large.isEmpty():
            return now if done is None else done.unionByName(now)
        joined = now.join(large, "top", "left")
        kept = joined.where("shared IS NULL").drop("shared")
        burst = joined.where("shared IS NOT NULL")
        ended = F.size("ids") == F.col("shared")
        moved = burst.withColumn("ended", ended).withColumn("depth", F.when(ended, F.col("shared")).otherwise(F.col("shared") + 1)).drop("shared")
        moved = moved.withColumn("top", _head(F.col("depth")))
        kept = cut_lineage(kept)
        done = kept if done is None else done.unionByName(kept)
        now = cut_lineage(moved.select(*kept.columns))


_NODE = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("top", pa.binary()), ("path", pa.list_(pa.binary())),
    ("words", pa.list_(pa.int64())),
])
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "top binary, path array<binary>, words array<long>"
)


def swept(depth: int, rows: list[tuple]) -> list[tuple]:
    """The nodes of a container from its top on: its sequences (ids, words, n, first, ends_sha256), sorted by ids.

    A stack holds the nodes on the way to the sequence at hand; each knows what has ended below it.  A node is listed
    when it begins, and its place filled in when it ends.
    """
    nodes: list[list] = []
    stack: list[list] = []

    def close() -> None:
        node = stack.pop()
        node[4] = node[4] or 1
        node[5] += (node[2] - 1) * node[6]
        if stack:
            up = stack[-1]
            up[0] = min(up[0], node[0])
            up[2] += node[2]
            up[3] += 1
            up[4] += node[4]
            up[5] += node[5]

    before: list = []
    for ids, words, n, first, ends in rows:
        same = depth
        while stack and same < min(len(before), len(ids)) and before[same] == ids[same]:
            same += 1
        while len(stack) > same - depth + 1:
            close()
        for at in range(depth + len(stack), len(ids) + 1):
            # least id, depth, conversations, children, leaves, saved, words of the last turn, ends, parent
            node = [first, at, 0, 0, 0, 0, words[at - 1] if at else 0, EMPTY_SHA, stack[-1] if stack else None]
            stack.append(node)
            nodes.append(node)
        stack[-1][0] = min(stack[-1][0], first)
        stack[-1][2] += n
        stack[-1][7] = ends
        before = ids
    while stack:
        close()
    return [(x[0], x[1], x[8][0] if x[8] else None, x[2], x[3], x[4], x[5], x[7]) for x in nodes]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of whole containers; rows come sorted by top and ids. The node at the top carries its path."""
    held: list[tuple] = []
    top, depth = None, 0

    def nodes() -> Iterator[pa.RecordBatch]:
        found = swept(depth, held)
        path, words = held[0][0][:depth], held[0][1][:depth]
        rows = [(*row, *((top, path, words) if not i else (None, None, None))) for i, row in enumerate(found)]
        for i in range(0, len(rows), 50_000):
            columns = zip(*rows[i : i + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE, strict=True)], schema=_NODE)

    for batch in batches:
        for own, at, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != top and held:
                yield from nodes()
                held = []
            top, depth = own, at
            held.append(tuple(row))
    if held:
        yield from nodes()


def _head_nodes(tops: DataFrame, ended: DataFrame) -> DataFrame:
    """(node, up, depth, conv_id, n_convs, n_leaves, saved_tokens, ends_sha256) of the head; stored.

    Every strict prefix of a container's top is a node of the head, and so is a node at which a sequence has ended
    when its container burst, with its prefixes. All of them have children, so leaves lie in containers.
    """
    zero = F.lit(0).cast("long")
    below = tops.select(
        F.col("path").alias("ids"), "words", (F.col("depth") - 1).cast("int").alias("last"), F.col("n_convs").alias("n"),
        F.col("conv_id").alias("first"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
        F.lit(None).cast("string").alias("ends"),
    )
    there = ended.select("ids", "words", F.col("depth").alias("last"), "n", "first", zero.alias("leaves"), zero.alias("saved"), F.col("ends_sha256").alias("ends"))
    rows = below.unionByName(there).where("last >= 0").withColumn("d", F.explode(F.sequence(F.lit(0), F.col("last"))))
    rows = rows.select(
        _head(F.col("d")).alias("node"), F.slice("ids", F.lit(1), F.col("d")).alias("ids"), "d", "n", "first", "leaves", "saved",
        F.when(F.col("d") == F.col("last"), F.col("ends")).alias("ends"), F.coalesce(F.get("words", F.col("d") - 1), zero).alias("words"),
    )
    heads = cut_lineage(rows.groupBy("node").agg(
        F.any_value("ids").alias("ids"), F.min("d").alias("d"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"), F.max("words").alias("words"),
    ))
    # what a node of the head saves counts for all nodes above it, too
    own = heads.select("ids", ((F.col("n_convs") - 1) * F.col("words")).alias("own"), F.explode(F.sequence(F.lit(0), F.col("d"))).alias("at"))
    inner = own.select(_head(F.col("at")).alias("node"), "own").groupBy("node").agg(F.sum("own").alias("own"))
    return cut_lineage(heads.join(inner, "node").select(
        "node", F.when(F.col("d") > 0, _head(F.col("d") - 1)).alias("up"), F.col("d").cast("long").alias("depth"), "conv_id", "n_convs", "n_leaves",
        (F.col("saved") + F.col("own")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    ))


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_nodes(sequences: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes of the trie of distinct sequences (see :func:`distinct_sequences`, stored)."""
    placed = containers(sequences, most_turns)
    rows = placed.where("NOT ended").select("top", "depth", "ids", "words", "n", "first", "ends_sha256")
    shards = rows.repartition("top").sortWithinPartitions("top", "ids")
    nodes = cut_lineage(shards.mapInArrow(_swept, NODE))
    tops = nodes.where("top IS NOT NULL")
    heads = _head_nodes(tops, placed.where("ended"))
    named = tops.withColumn("ids", F.col("path")).withColumn("up", F.when(F.col("depth") > 0, _head((F.col("depth") - 1).cast("int"))))
    parents = heads.select(F.col("node").alias("up"), F.col("conv_id").alias("parent"))
    children = named.select("up").unionByName(heads.select("up")).groupBy("up").agg(F.count("*").alias("n_children"))
    tops = named.join(parents, "up", "left").withColumn("parent_conv_id", F.col("parent"))
    own = heads.join(parents, "up", "left").withColumn("parent_conv_id", F.col("parent"))
    own = own.join(children.withColumnRenamed("up", "node"), "node")
    inner = nodes.where("top IS NULL")
    return inner.select(*COLUMNS).unionByName(tops.select(*COLUMNS)).unionByName(own.select(*COLUMNS))


def conversation_trie(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    most_turns: int = MOST_TURNS,
) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations: ``COLUMNS``.

    Turns are ordered by ``turn``, null first; ties by role and then a digest of the text. A null role or text is
    empty. Rows without a conversation id belong to no conversation. Rows that repeat are turns of their own. The
    turns of a conversation (digests and word counts, no texts) are one row of a task. An empty table has no root;
    other columns are not read.
    """
    convs = rebuilt(conversations, conv_col, turn_col, role_col, text_col)
    return trie_nodes(cut_lineage(distinct_sequences(convs)), most_turns)
