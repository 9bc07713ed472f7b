"""The language model against a plain one over all words, with more words than the cache holds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloom.llm import katz


def plain(tokens):
    """log10 probabilities of token lists by a Katz model of the training ones, straight from its definition."""
    train = [own for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 10]
    count = Counter(t for own in train for t in own)
    pairs = Counter(p for own in train for p in zip(["<start>", *own], own))
    unigram = lambda w: (count[w] + 0.1) / (sum(count.values()) + 0.1 * (len(count) + 1))
    discount = katz.good_turing([sum(n == r for n in pairs.values()) for r in range(1, katz.DISCOUNTED + 2)])
    after = defaultdict(dict)
    for (h, w), n in pairs.items():
        after[h][w] = n
    share, weight = {}, {}
    for h, own in after.items():
        kept = {w: discount[min(n, katz.DISCOUNTED + 1)] * n for w, n in own.items()}
        total = sum(own.values()) + (sum(own.values()) - sum(kept.values()) <= 1e-9)
        share |= {(h, w): n / total for w, n in kept.items()}
        weight[h] = (1 - sum(kept.values()) / total) / (1 - sum(map(unigram, own)))
    log = lambda h, w: np.log10(share[h, w] if (h, w) in share else weight.get(h, 1) * unigram(w))
    return {d: sum(log(h, w) for h, w in zip(["<start>", *own], own)) for d, own in tokens.items()}


@pytest.mark.parametrize("size", [1, 7, 50_000])
def test_score_equals_a_model_of_all_words(spark, size, monkeypatch):
    monkeypatch.setattr(katz, "HOT_PAIRS", 30)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words[: rng.choice([4, 20, 60])]) for _ in range(rng.randint(1, 50))) for _ in range(80)]
    texts += [None, "", "new words only", "w1 new w2 w2 new", "w1 w2 " * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected = plain({d: [*(t or "").encode().split(), None] for d, t in enumerate(texts)})
    got = {r.doc_id: r.score for r in katz.score(docs, size=size).collect()}
    assert got == {d: pytest.approx(x, rel=1e-9) for d, x in expected.items()}
