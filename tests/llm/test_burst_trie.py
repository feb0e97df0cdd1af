"""The trie of conversations against one built node by node."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tierstone.llm import burst_trie as b


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuild(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        parents = {x[:-1] for x in members if x}
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(c for c in own if len(convs[c]) == len(node)))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(len(x) == len(node) + 1 for x in below),
            sum(x not in parents for x in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def corpus(seed, n, common):
    rd = random.Random(seed)
    turns = [(rd.choice(["user", "assistant", None, ""]), " ".join("w%d" % rd.randrange(9) for _ in range(rd.randrange(5)))) for _ in range(6)]
    turns += [("a b", "c"), ("a", "b c"), ("user", "x\x1fy\x0bz"), ("user", None)]
    rows = []
    for c in rd.sample(range(3 * n), n):
        length = rd.randrange(7)
        own = [rd.choice(turns[:3]) if rd.random() < common else rd.choice(turns) for _ in range(length)]
        rows += [(c, i if i or rd.random() < 0.8 else None, *t) for i, t in enumerate(own)]
    rows += [(None, 1, "user", "lost"), (9_000, 3, "user", "b"), (9_000, 3, "user", "b"), (9_000, 3, "assistant", "b"), (9_000, None, "user", "c")]
    rd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, n, common, most, partitions", [(1, 60, 0.5, 200_000, 1), (2, 90, 0.95, 4, 5), (3, 120, 0.8, 1, 3), (4, 40, 1.0, 12, 4)])
def test_equals_node_by_node(spark, seed, n, common, most, partitions):
    """Also where nearly every container bursts."""
    rows = corpus(seed, n, common)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, top string, ids int").repartition(partitions)
    got = b.conversation_trie(df, most_turns=most).select(*b.COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_a_long_shared_start_bursts_at_once(spark):
    rows = [(c * 20, i, "user", f"t{i}") for c in range(12) for i in range(30)] + [(c * 20, 30, "user", f"own{c}") for c in range(12)]
    rows += [(20_000, i, "user", f"t{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, b.conversation_trie(df, most_turns=10).collect()), key=str) == brute(rows)


def test_many_ids_are_joined_in_ranges(spark):
    rows = [(c * 20, 0, "user", "hi") for c in range(3 * b.ID_RANGE // 20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, b.conversation_trie(df).collect()), key=str) == brute(rows)


def test_turnless_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    got = b.conversation_trie(spark.createDataFrame([(alone, 0, "user", "gone")], schema)).collect()
    assert [tuple(r) for r in got] == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    assert b.conversation_trie(spark.createDataFrame([], schema)).collect() == []
