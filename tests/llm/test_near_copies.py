"""Near copies of the pipeline start from SimHash."""

import random

import numpy as np

from lakeloom.llm import overlap, simhash


def test_fingerprints_of_all_documents_are_walked_and_checked(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    texts = [[rng.choice(words) for _ in range(150)] for _ in range(30)]
    texts += [[*own[:-1], "changed"] for own in texts[:10]]
    table = [" ".join(t) for t in texts] + ["one two", None]
    walked, judged = [], []

    def links(distinct, *args):
        walked.extend(r.fp for r in distinct.collect())
        return simhash.near_links(distinct, *args)

    def stars(given, *args):
        found = own_stars(given, *args)
        judged.append({frozenset(r) for r in found.collect()})
        return found

    own_stars = overlap._stars
    monkeypatch.setattr(overlap, "near_links", links)
    monkeypatch.setattr(overlap, "_stars", stars)
    docs = spark.createDataFrame(list(enumerate(table)), "doc_id long, text string")
    got = {r.doc_id for r in overlap.first_of_each(docs, 5, 80).collect()}
    prints = [np.uint64(simhash.fingerprint(t)) for t in table]
    assert set(walked) == {int(p.view(np.int64)) for p, t in zip(prints, table) if t}
    set_id = lambda k: overlap.set_id(overlap.shingle_set(table[k], 5))
    near = {frozenset((set_id(k), set_id(k + 30))) for k in range(10) if (int(prints[k]) ^ int(prints[k + 30])).bit_count() <= simhash.BUDGET}
    rest = {frozenset((set_id(k), set_id(k + 30))) for k in range(10)} - near
    assert near and judged == [near, rest]  # what SimHash links is not compared again, what it misses is
    assert got == {*range(30), 40, 41}
