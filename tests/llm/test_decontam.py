"""The latent basis against a plain one."""

import random

import numpy as np

from lakeloom.llm import decontam


def test_basis_is_fitted_on_all_documents(spark, monkeypatch):
    monkeypatch.setattr(decontam, "RANK", 6)
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    items = decontam.Items([(k, " ".join(rng.sample(vocabulary, 30))) for k in range(4)])
    topics = [rng.sample(vocabulary, 12) for _ in range(5)]
    texts = [" ".join(rng.choice(topics[k % 5]) for _ in range(20)) for k in range(3500)]
    texts += [" ".join(vocabulary[:15])] * 1500  # one text, in a sample by its hash wholly or not at all
    texts += [" ".join(vocabulary[40:60])] * 1500
    found = decontam.fit(spark.createDataFrame([(t,) for t in texts], "text string").repartition(6), items)

    size = len(items.known)
    seen = np.zeros(size)
    coded = items.encode(texts)
    for own in coded:
        seen[np.unique(own[own >= 0])] += 1
    idf = np.log((len(texts) + 1) / (seen + 1)) + 0.05
    rows = np.zeros((len(texts), size))  # texts this short are one passage each
    for row, own in zip(rows, coded):
        some, n = np.unique(own[own >= 0], return_counts=True)
        row[some] = (1 + np.log(n)) * idf[some]
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((size, 6)))[0]
    for _ in range(decontam.ROUNDS):
        basis = np.linalg.qr(rows.T @ (rows @ basis) + decontam._segments_gram(items, idf, basis, len(texts)))[0]
    assert np.abs(found.basis @ found.basis.T - basis @ basis.T).max() < 1e-3


def test_cosines_find_what_shared_weight_does_not(spark):
    common, rare = [f"common{k}" for k in range(13)], [f"rare{k}" for k in range(7)]
    item = " ".join([w for pair in zip(common[:7], rare) for w in pair] + common[7:10]) + ". " + " ".join(common[10:])
    rng = random.Random(3)
    rows = [(k, " ".join(rng.sample(common, 13))) for k in range(52)] + [(52, " ".join(common))] + [(k, "other words") for k in range(53, 399)]
    docs = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")  # the common words have 41 of 100 parts of the item's length and 39 of its weight
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    items = decontam.Items([(7, item)])
    search = decontam.fit(docs, items)
    coded = items.encode([rows[52][1]])
    passages = decontam.Passages(coded, len(items.known))
    assert not list(search._candidates(passages, np.append(passages.starts, len(passages.word))))
    found = decontam.leaks(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.share) for r in found] == [(52, 7, 0.65)] and found[0].cosine > decontam.NEAR
    assert {r.doc_id for r in decontam.without_leaks(docs, bench).collect()} == {k for k in range(399) if k != 52} | {None}


def test_cosines_alone_find_planted_items(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(1500)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(120)]
    items = decontam.Items(list(enumerate(texts)))
    assert len(items.segments) > decontam.RANK
    filler = lambda: [rng.choice(vocabulary) for _ in range(60)]
    verbatim = [" ".join([*filler(), t, *filler()]) for t in texts]
    loose = [" ".join([*filler(), *[w for k, w in enumerate(t.split()) if k % 6 != 2], *filler()]) for t in texts]
    docs = verbatim + loose + [" ".join(filler() + filler()) for _ in range(600)]
    search = decontam.fit(spark.createDataFrame([(t,) for t in docs], "text string").repartition(4), items)
    coded = items.encode(docs)
    rows = decontam.Passages(coded, len(items.known))
    near = search.latent(rows, rows.weights(search.idf), np.append(rows.starts, len(rows.word)))
    found = {(int(rows.doc[p]), items.segments[q][0]) for p, q in search.by_cosine(coded, rows, near)}
    assert {(k, k) for k in range(120)} <= found
    assert sum((120 + k, k) in found for k in range(120)) >= 0.9 * 120
