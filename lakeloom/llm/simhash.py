"""Near-duplicates by SimHash and a self-join of a binary trie.

A text's fingerprint has the majority bits of its word shingles' hashes. Distinct fingerprints form
a trie by bits; node pairs are traversed together, differing bits add up, and a pair is dropped
when it exceeds its budget. The trie is walked in ``turns`` rotations of the bits: of any pair
with ``budget`` differing bits, at least one rotation has, in every leading run of j blocks of
64 / turns bits, at most its share budget * j / turns of them. So the budget grows with the depth
and most pairs end near the root. Spark deals the top of the trie: a fingerprint goes to its
node's pairs with itself and with the nodes within the budget, pairs with too many fingerprints
are dealt again further down, and a task walks the rest of its pairs with arrays. Of the links
in a pair of nodes a spanning forest is passed on, which keeps the components and bounds the
edges by the number of fingerprints. Components come from alternating large-star and small-star steps.

A text without words (null, empty, white space) has fingerprint zero and links like any other. Null
doc_ids take part but name no component unless no other id is there (then null). Repeated rows
share a fingerprint. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import give_back, staged

SEED, WORDS, BUDGET, TURNS = 42, 3, 3, 2
#: Fingerprints that a task walks at once, and when a node pair is dealt again.
LEAF, HOT = 20_000, 60_000
#: Fingerprints of a walk after which a worker returns memory.
LARGE = 4_000
_STEP = 4  # bits by which a hot pair moves down


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the shingles' XXH64."""
    import xxhash

    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    runs = [parts] if len(parts) < words else zip(*(parts[k:] for k in range(words)))
    n = max(1, len(parts) - words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, *keep: str, words: int = WORDS) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed 64-bit number."""
    picked = rows.select(*keep, F.col("text").alias("__text"))
    names = list(keep)

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column("__text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.int64())], names=[*names, "fp"])

    return picked.mapInArrow(run, picked.select(*names).schema.add("fp", "long"))


def allowed(depth: int, budget: int, turns: int) -> int:
    """Differing bits that a pair may have in the first ``depth`` bits of a rotation."""
    return budget * -(-depth * turns // 64) // turns


def _masks(bits: int, most: int) -> list[int]:
    found = [0]
    for k in range(bits):
        found += [m | 1 << k for m in found if m.bit_count() < most]
    return found


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, differ: int, budget: int, turns: int):
    """Index pairs of linked values of two sorted nodes (b None: of one with itself), in batches."""
    own = b is None
    b = a if own else b
    low_a, high_a, low_b, high_b = (np.array([x], np.int64) for x in (0, len(a), 0, len(b)))
    errors, same = np.array([differ], np.int64), np.array([own])
    for bit in range(depth, 65):
        size = (high_a - low_a) * (high_b - low_b)
        leaf = (size <= 64) | (bit == 64)
        yield from _leaves(a, b, low_a[leaf], high_a[leaf], low_b[leaf], high_b[leaf], same[leaf], budget)
        go = ~leaf
        if bit == 64 or not go.any():
            return
        low_a, high_a, low_b, high_b, errors, same = (x[go] for x in (low_a, high_a, low_b, high_b, errors, same))
        shift = np.uint64(63 - bit)
        ones_a, ones_b = (np.concatenate([[0], np.cumsum((v >> shift & np.uint64(1)).astype(np.int64))]) for v in (a, b))
        mid_a = high_a - (ones_a[high_a] - ones_a[low_a])
        mid_b = high_b - (ones_b[high_b] - ones_b[low_b])
        parts = (
            (low_a, mid_a, low_b, mid_b, errors, same), (mid_a, high_a, mid_b, high_b, errors, same),
            (low_a, mid_a, mid_b, high_b, errors + 1, np.zeros_like(same)),
            tuple(x[~same] for x in (mid_a, high_a, low_b, mid_b, errors + 1, same)),
        )
        low_a, high_a, low_b, high_b, errors, same = (np.concatenate(x) for x in zip(*parts))
        keep = (high_a > low_a) & (high_b > low_b) & (errors <= allowed(bit + 1, budget, turns))
        low_a, high_a, low_b, high_b, errors, same = (x[keep] for x in (low_a, high_a, low_b, high_b, errors, same))


def _leaves(a, b, low_a, high_a, low_b, high_b, same, budget):
    """Compare all values of small node pairs, a bounded number at a time."""
    wide = high_b - low_b
    size = (high_a - low_a) * wide
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), "right")))
        n = size[start:stop]
        pair = np.repeat(np.arange(start, stop), n)
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = low_a[pair] + nth // wide[pair]
        j = low_b[pair] + nth % wide[pair]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        near &= ~same[pair] | (i < j)
        yield i[near], j[near]
        start = stop


def forest(n: int, batches) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the linked numbers below n."""
    root = np.arange(n)
    kept: list[tuple[int, int]] = []
    for i, j in batches:
        i, j = root[i], root[j]  # labels from before this batch drop most of the repeats
        apart = i != j
        edges = np.unique(np.stack([np.minimum(i[apart], j[apart]), np.maximum(i[apart], j[apart])], 1), axis=0)
        if not len(edges):
            continue
        up = {}

        def find(x, up=up):
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        for x, y in edges.tolist():
            p, q = find(x), find(y)
            if p != q:
                up[max(p, q)] = min(p, q)
                kept.append((x, y))
        moved = np.array([[x, find(x)] for x in up], np.int64)
        table = np.arange(n)
        table[moved[:, 0]] = moved[:, 1]
        root = table[root]
    return kept


def near_links(distinct: DataFrame, budget: int = BUDGET, turns: int = TURNS) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp`` that connect all within the budget."""
    total = distinct.count()
    depth = min(24, max(1, (total // LEAF).bit_length()))
    width = 64 // turns
    turned = distinct.select(F.explode(F.expr("array(" + ", ".join(f"named_struct('turn', {k}, 'v', {_rotated('fp', k * width)})" for k in range(turns)) + ")")).alias("t"))
    masks = F.expr("array(" + ", ".join(f"{m}L" for m in _masks(depth, allowed(depth, budget, turns))) + ")")
    rows = turned.select("t.turn", "t.v", F.lit(depth).alias("depth"), F.explode(masks).alias("mask"))
    done = None
    while True:
        node = F.expr("shiftrightunsigned(v, 64 - depth)")
        rows = rows.withColumn("node", F.least(node, node.bitwiseXOR(F.col("mask"))))
        key = ["turn", "depth", "node", "mask"]
        hot = rows.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > HOT) & (F.col("depth") <= 60)).select(*key)
        hot = staged(hot, "hot-nodes")
        if not hot.take(1):
            return _edges(rows if done is None else done.unionByName(rows), key, budget, turns)
        calm = rows.join(F.broadcast(hot) if hot.count() < 10_000 else hot, key, "left_anti")
        done = calm if done is None else done.unionByName(calm)
        depth += _STEP
        steps = F.expr("array(" + ", ".join(f"{m}L" for m in range(1 << _STEP)) + ")")
        down = rows.join(F.broadcast(hot) if hot.count() < 10_000 else hot, key, "left_semi").select(
            "turn", "v", F.lit(depth).alias("depth"), F.col("mask").alias("above"), F.explode(steps).alias("step"))
        rows = down.withColumn("mask", F.expr(f"shiftleft(above, {_STEP}) | step")).where(
            F.expr(f"bit_count(mask) <= {allowed(depth, budget, turns)}")).select("turn", "v", "depth", "mask")


def _rotated(column: str, bits: int) -> str:
    return column if not bits else f"(shiftleft({column}, {bits}) | shiftrightunsigned({column}, {64 - bits}))"


def _edges(rows: DataFrame, key: list[str], budget: int, turns: int) -> DataFrame:
    width = 64 // turns

    def run(name, table):
        turn, depth, node, mask = (x.as_py() for x in name)
        values = np.sort(table.column("v").to_numpy().view(np.uint64))
        whole = node & ((1 << depth) - 1)
        first = values >> np.uint64(64 - depth) == np.uint64(whole)
        if mask == 0:
            found = walk(values, None, depth, 0, budget, turns)
            pairs = forest(len(values), found)
        else:
            a, b = values[first], values[~first]
            values = np.concatenate([a, b])
            pairs = forest(len(values), ((i, j + len(a)) for i, j in walk(a, b, depth, mask.bit_count(), budget, turns))) if len(a) and len(b) else []
        back = np.uint64(64 - turn * width if turn else 0)
        if turn:
            values = (values << back) | (values >> np.uint64(turn * width))
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        if len(values) >= LARGE:
            give_back()
        u, v = values[ends[:, 0]].view(np.int64), values[ends[:, 1]].view(np.int64)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy(*key).applyInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; the root is the component's smallest node."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")


def near_groups(prints: DataFrame, budget: int = BUDGET, turns: int = TURNS) -> DataFrame:
    """``fp, component_id`` from rows ``doc_id, fp``: the smallest doc_id that links reach."""
    firsts = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(near_links(firsts.select("fp"), budget, turns))
    named = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint and component."""
    prints = staged(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id"), "prints")
    groups = near_groups(prints)
    return prints.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
