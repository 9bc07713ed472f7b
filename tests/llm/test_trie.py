"""The conversation trie against brute force, with deep conversations, copies, ties and odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakeloom.llm import trie

KINDS = "conv_id long, turn long, role string, text string, depth int, path string, n_convs int"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(members[k]) - 1) * len(k[-1][1]) if k else 0
    digest = lambda k: hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k], digest(k)) for k, m in members.items())


def table():
    rng = random.Random(13)
    said = ["hello", "Hello", "", None, "größe", "x" * 5000, "ok"]
    rows = []
    for c in [*range(0, 130), 200, 205, 299, 350, 1000, 1007, -5, -100, -103]:
        for k in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, k, rng.choice(["user", "assistant", None]), rng.choice(said)))
    deep = [("user" if k % 2 else "assistant", f"t{k}") for k in range(90)]
    for c, n in ((300, 90), (301, 90), (302, 70), (303, 33), (304, 16), (305, 17), (306, 90)):
        rows += [(c, k, *deep[k]) for k in range(n)]
    for c in range(400, 490):  # copies of one conversation
        rows += [(c, k, *deep[k]) for k in range(7)]
    rows += [(310, 5, "user", "b"), (310, 5, "user", "a"), (310, None, "user", "first"), (310, 5, "user", "a"), (None, 1, "user", "nobody"), (320, 1, None, None), (500, 1, "", "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height, span", [(trie.HEIGHT, trie.SPAN), (3, 4), (2, 7)])
def test_nodes_equal_brute_force(spark, height, span):
    rows = table()
    got = trie.nodes_of(spark.createDataFrame([(*r, 1, "clash", 1) for r in rows], KINDS).repartition(4), height, span)
    assert all(t == "bigint" for c, t in got.dtypes if c != "ends_sha256")
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty_table(spark):
    assert trie.nodes_of(spark.createDataFrame([], KINDS)).count() == 0
    assert trie.nodes_of(spark.createDataFrame([(None, 1, "a", "b", 1, "", 1)], KINDS)).count() == 0


def test_conversation_without_turns_left(spark):
    """Its base is absent and it has fewer turns than are replaced: a member of the root only."""
    c = next(c for c in range(701, 799) if zlib.crc32(str(c).encode()) % 6 > 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    got = trie.nodes_of(spark.createDataFrame([(*r, 1, "", 1) for r in rows], KINDS)).collect()
    assert list(map(tuple, got)) == brute(rows) and len(got) == 1
