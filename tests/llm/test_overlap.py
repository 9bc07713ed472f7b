"""The n-gram Jaccard join against brute force: near copies, a hot group, shared passages, small and odd rows."""

import random

import numpy as np
import pytest

from lakeloom.llm import overlap

KINDS = "doc_id long, text string, lang string, fp long, n int, cols string, root string"


def shingles(text, words=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute(table, least):
    sets, root = [shingles(t) for _, t in table], list(range(len(table)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for k, (doc_id, _) in enumerate(table):
        if doc_id is not None:
            smallest[find(k)] = min(smallest.get(find(k), doc_id), doc_id)
    return sorted(((d, len(s), smallest.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(table, sets))), key=repr)


def texts():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(2000)]
    made = [[rng.choice(words) for _ in range(n)] for n in (*range(1, 40), *(rng.randint(40, 400) for _ in range(40)))]
    for own in made[:79]:
        for edits in (1, 2, 4, 8):
            copy = list(own)
            for k in rng.sample(range(len(copy)), min(edits, len(copy))):
                copy[k] = rng.choice(words)
            made.append(copy)
        made.append(own[: max(1, len(own) * 9 // 10)])
        made.append(own + own[: len(own) // 8])
    hot = made[70]
    for _ in range(150):  # near copies at the edge of the bound, most of them not alike one another
        copy = list(hot)
        for k in rng.sample(range(len(copy)), rng.randint(1, len(copy) // 22)):
            copy[k] = rng.choice(words)
        made.append(copy)
    passage = made[60][:60]
    made += [passage + [rng.choice(words) for _ in range(rng.randint(0, 60))] for _ in range(60)]
    rng.shuffle(made)
    return [" ".join(t) for t in made]


@pytest.mark.parametrize("least, cap, most", [(85, overlap.CAP, overlap.ROWS), (85, 4000, 16), (60, 1 << 30, 8)])
def test_classes_equal_brute_force(spark, least, cap, most):
    own = texts()
    table = [*enumerate(own), (9000, own[5].upper()), (9001, own[5]), (9001, own[5]), (9002, None), (9003, ""), (9004, " \n"), (9005, "one two"), (9006, "ONE\ttwo"), (9007, "one"), (None, own[7]), (None, "alone here"), (-3, own[9]), (9008, "é é é"), (9009, "z" * 100_000), (9010, " ".join(map(str, range(30_000)))), (9011, " ".join(map(str, range(100, 30_100))))]
    docs = spark.createDataFrame([(d, t, "en", 1, 1, "x", "x") for d, t in table], KINDS).repartition(5)
    got = overlap.classes(docs, least=least, cap=cap, most=most)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(table, least)


def test_empty_table(spark):
    assert overlap.classes(spark.createDataFrame([], KINDS)).count() == 0


def test_product_equals_sets():
    rng = np.random.default_rng(3)
    make = lambda n: [np.unique(np.concatenate([rng.integers(0, 50, 20), rng.integers(0, 9000, rng.integers(1, 300))])).astype(np.uint64) for _ in range(n)]
    a, b = make(70), make(45)
    assert overlap.overlaps(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    wide = [np.arange(k, 9000 + k, dtype=np.uint64) for k in range(3)]
    assert overlap.overlaps(wide, wide).tolist() == [[9000 - abs(i - j) for j in range(3)] for i in range(3)]
