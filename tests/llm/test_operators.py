"""The ten operators against brute force on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import arc, decontam, digest, katz, langid, packing, sharding, simhash, suffix, token_file
from lakeloom.llm.common import scratch_dir
from lakeloom.llm.token_file import tokenizer_path

KINDS = "doc_id long, text string, lang string, source string, n_chars long, part int, bucket string"


def rows():
    rng = random.Random(5)
    words = ["river", "stone", "Über", "alpha", "the", "of", "naïve", "x1", "end.", "go,"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts += [None, "", " ", "a", "\n\n", "a  b", texts[0], texts[0], texts[1] + " tail", "y" * 3000, " ".join(words * 400), "日本 語", "12 34"]
    return [(i, t, "en" if i % 2 else "de", "s", len(t or ""), 1, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), KINDS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids."""
    return spark.createDataFrame([(None, "some text " * 9, None, "s", 1, 1, "x"), (1, "some text " * 9, "en", "s", 1, 1, "x"), (1, "some text " * 9, "en", "s", 1, 1, "x"), (None, None, None, None, None, None, None)], KINDS)


def test_shards_are_a_permutation(docs, none, odd):
    got = sharding.shard(docs, 7).toPandas()
    n = len(got)
    assert sorted(got.slot * 7 + got.shard) == list(range(n))
    assert list(got.sort_values("row_number").doc_id) == [r[0] for r in rows()]
    by = {r[0]: (r[1] or "").encode() for r in rows()}
    assert all(s == len(by[d]) + 16 and c == zlib.crc32(by[d]) for d, s, c in zip(got.doc_id, got["size"], got.text_crc32))
    assert sharding.shard(none, 7).count() == 0 and sharding.shard(odd, 7).count() == 4


def test_permutation_can_be_inverted(spark):
    for n in (1, 2, 3, 37, 1000):
        ids = spark.range(n).withColumn("p", sharding.permuted("id", n)).withColumn("back", sharding.permuted("p", n, inverse=True)).toPandas()
        assert sorted(ids.p) == list(range(n)) and (ids.back == ids.id).all()


def test_language(docs, none, spark):
    train = [(i, t, l, "s", 0, 1, "x") for i, (t, l) in enumerate([("the river of the stone and the", "en"), ("der fluss und die steine der", "de")] * 40)]
    held = [(900, "the stone and river", None, None, None, None, None), (901, "die steine und der fluss", None, None, None, None, None), (902, None, None, None, None, None, None), (903, "12 !", "en", None, None, None, None)]
    got = langid.predict_all(spark.createDataFrame(train + held, KINDS)).toPandas().set_index("doc_id")
    assert got.lang_pred[900] == "en" and got.lang_pred[901] == "de" and got.lang_pred[902] == got.lang_pred[903] == "und"
    assert got.score.between(0, 1).all() and langid.predict_all(none).count() == 0
    assert langid.predict_all(docs).count() == len(rows())


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 0, 6, 1])
    scores = rng.normal(size=(11, 3)) * 3
    got = langid.viterbi(scores, lengths, 2.0)
    at = 0
    for n in lengths:
        own = scores[at : at + n]
        value = lambda path: sum(own[k, s] for k, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        best = max((np.unravel_index(i, (3,) * n) for i in range(3**n)), key=value, default=()) if n else ()
        assert value(tuple(got[at : at + n])) == pytest.approx(value(best))
        at += n


def encoded(name):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.encode_special_tokens = True
    return {r[0]: [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows()}


def test_packing_covers_every_piece_once(docs, none, odd):
    got = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), lowers=False, end=2).toPandas()
    ids = encoded("byte_bpe_50k.json")
    for doc, own in got.sort_values("piece").groupby("doc_id"):
        n = len(ids[doc])
        assert own.start.tolist() == [0, *(own.length.cumsum().tolist()[:-1])] and own.length.sum() == n and (own.length[1:] == 1024).all()
        assert [zlib.crc32(np.array(ids[doc][a : a + k], "<u4")) for a, k in zip(own.start, own.length)] == own.ids_crc32.tolist()
    assert set(got.doc_id) == set(ids)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *(own.length.cumsum().tolist()[:-1])] and own.length.sum() <= 1024
    for other, n in ((none, 0), (odd, 4)):
        assert packing.pack(other, tokenizer_path("byte_bpe_50k.json"), lowers=False, end=2).count() == n


def test_plan_covers_the_histogram_near_the_bound():
    rng = np.random.default_rng(2)
    need = Counter(rng.integers(1, 400, 5000).tolist()) + Counter({1024: 9})
    plan = packing.solve(need)
    covered = Counter()
    for found, times in plan:
        assert sum(k * c for k, c in found.items()) <= 1024
        for k, c in found.items():
            covered[k] += c * times
    assert covered == need and sum(t for _, t in plan) <= 1.02 * sum(k * n for k, n in need.items()) / 1024 + 1


def test_token_files(docs, none, odd, spark):
    got = token_file.token_file_digest(docs, tokenizer_path("word_bpe_49k.json"), lowers=True, end=2).toPandas().set_index("doc_id")
    start = 0
    for doc, ids in sorted(encoded("word_bpe_49k.json").items()):
        assert (got.start[doc], got.n_tokens[doc], got.ids_crc32[doc]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    files = token_file.write_token_files(docs, scratch_dir(spark, "t"), tokenizer_path("word_bpe_49k.json"), lowers=True, end=2, length=8, batch_rows=4).collect()
    held = token_file.TokenFile(max(files, key=lambda f: f.n_tokens).path)
    ids, mask = held.sequence(5)
    assert len(ids) == 8 and mask.all() and (ids == held.tokens(40, 8)).all()
    assert token_file.token_file_digest(none, tokenizer_path("word_bpe_49k.json"), lowers=True, end=2).count() == 0
    assert token_file.token_file_digest(odd, tokenizer_path("word_bpe_49k.json"), lowers=True, end=2).count() == 4


def test_archives(spark):
    body = "<p>é</p>" * 300
    pages = [(1, "http://a b", body), (2, None, body), (3, "http://c", None), (4, "u#x", "WARC/1.1\r\n\r\nshort\n"), (9, "http://d", body), (None, "e", "z" * 2000)]
    got = arc.round_trip(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, record string")).toPandas()
    assert len(got) == 6
    for p in pages:
        own = got[got.page_id == p[0]].iloc[0] if p[0] else got[got.page_id.isna()].iloc[0]
        raw = (p[2] or "").encode()
        assert own.payload_bytes == len(raw) and own.payload_digest == hashlib.sha1(raw).hexdigest()
        assert (own.record_type, own.refers_to if own.record_type == "revisit" else None) == (("revisit", 9) if p[0] in (1, 2) else ("response", None))
    assert arc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_leaks(spark, none):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [text(30) + ". " + text(6) + "." for _ in range(6)]
    paraphrase = items[1].split()
    del paraphrase[3::6]
    table = [text(200) for _ in range(20)] + [text(90) + " " + items[0].upper() + " " + text(90), " ".join(paraphrase), None, ""]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(table)], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(made, bench).collect()} == {(20, 0), (21, 1)}
    assert {r.doc_id for r in decontam.without_leaks(made, bench).collect()} == set(range(24)) - {20, 21}
    assert decontam.leaks(made, bench.limit(0)).count() == 0 and decontam.leaks(none, bench).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_words(a, np.array(b)) == table[-1][-1]


def test_model_sums_to_one_and_counts_exactly(docs, none, odd):
    got = katz.score(docs, size=5).toPandas().set_index("doc_id")
    tokens = {r[0]: [*(r[1] or "").encode().lower().split(), None] for r in rows()}
    train = [t for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 10 for t in own]
    count, n = Counter(train), len(train)
    for d, own in tokens.items():
        base = sum(np.log10((count[t] + 0.1) / (n + 0.1 * (len(count) + 1))) for t in own)
        assert got.base_score[d] == pytest.approx(base) and got.n_tokens[d] == len(own) and got.train_tokens[d] == n
        assert got.n_known[d] == sum(count[t] > 0 for t in own) and got.score[d] <= 0
    assert katz.score(none).count() == 0 and katz.score(odd).count() == 4


def test_backoff_is_normalised(docs, spark):
    words = katz.word_counts(docs, 4)
    vocab = spark.sparkContext.broadcast(katz.vocabulary(words, 6))
    pairs = katz.pair_counts(docs, vocab, 4)
    v, m = vocab.value, katz.Backoff(pairs, vocab, 10)
    seen = {}
    for r in pairs.collect():
        keys, n = katz.unpacked(bytes(r.data))
        seen.update({(int(k) >> 32, int(k) & 0xFFFFFFFF): int(c) for k, c in zip(keys, n)})
    classes = np.arange(v.size + 1)
    for h in range(v.start + 1):
        total = sum(10 ** float(m.seen(np.array([h]), np.array([seen[h, w]]))[0]) if (h, w) in seen else 10 ** float(m.unseen(v, np.array([h]), np.array([w]))[0]) for w in classes)
        assert total == pytest.approx(1.0)


def test_near_duplicates_equal_brute_force(docs, none, odd):
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id")
    prints = np.array([simhash.fingerprint(r[1]) for r in rows()], np.uint64)
    assert got.fingerprint.tolist() == [f"{int(f):016x}" for f in prints]
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if int(prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got.component_id.tolist() == root
    assert simhash.near_duplicates(none).count() == 0 and simhash.near_duplicates(odd).count() == 4


@pytest.mark.parametrize("budget, turns", [(3, 2), (6, 4)])
def test_trie_walk_finds_every_pair(spark, budget, turns, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 40)  # pairs of nodes are dealt again further down
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    some = {int(b) for b in base}
    for b in base:
        for _ in range(3):
            flips = rng.choice(64, rng.integers(1, 9), replace=False)
            some.add(int(b) ^ sum(1 << int(k) for k in flips))
    values = sorted(some)
    edges = simhash.near_links(spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long"), budget, turns)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    signed = {v: int(np.uint64(v).view(np.int64)) for v in values}
    label = lambda v: roots.get(signed[v], signed[v])
    group = {v: v for v in values}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= budget:
                x, y = group[a], group[b]
                group = {k: (x if g == y else g) for k, g in group.items()}
    assert {(label(a) == label(b)) == (group[a] == group[b]) for a in values for b in values} == {True}


def test_suffix_array_equals_sorting():
    rng = random.Random(2)
    for _ in range(500):
        s = [rng.randint(1, rng.choice([2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_removal_equals_brute_force(spark, docs, none, odd):
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randint(49, 140))) for _ in range(6)]
    texts = ["".join(rng.choice("xyzé ") * rng.randint(0, 30) + rng.choice(passages)[rng.randint(0, 9):] for _ in range(rng.randint(1, 4))) for _ in range(60)] + [None, "", "ab" * 100, "ab" * 90]
    got = suffix.removed(spark.createDataFrame([(i, t, 1, "b") for i, t in enumerate(texts)], "doc_id long, text string, block int, data string")).toPandas().set_index("doc_id")
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], i)
    for i, b in enumerate(raw):
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        assert tuple(got.loc[i]) == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert suffix.removed(docs).count() == len(rows()) and suffix.removed(none).count() == 0
    assert sorted(r.n_removed for r in suffix.removed(odd).collect()) == [0, 0, 0, 90]


def test_digests(docs, none, odd):
    got = digest.digests(docs).toPandas().sort_values("doc_id", ascending=False).reset_index(drop=True)
    texts = [r[1] or "" for r in rows()][::-1]
    for k, text in enumerate(texts):
        after, n = texts[(k + 1) % len(texts)], len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        assert got.n_chars[k] == len(text) and got.edited_sha256[k] == hashlib.sha256(edited.encode()).hexdigest()
    assert got.assign(t=texts).groupby("t").fingerprint.nunique().max() == 1
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert digest.digests(none).count() == 0 and digest.digests(odd).count() == 4


def test_entropy_of_every_window():
    data = np.frombuffer(b"aabbccddeeffgghhiijjkkllmmnnoopp" * 2 + bytes(range(64)), np.uint8)
    got = digest.entropy_bins(data)
    for k in range(len(got)):
        share = np.bincount(data[k : k + 32]) / 32
        share = share[share > 0]
        assert abs(got[k] - -(share * np.log2(share)).sum() / 5 * 1000) < 3


def test_long_texts_without_a_winner_have_features():
    """Of a text whose windows all tie, the best one is taken, however many chunks it has."""
    ranks = np.arange(digest.BINS + 1)
    for n in (200, digest.CHUNK, 3 * digest.CHUNK + 17):
        one, other, mixed = digest.features([b"a" * n, b"bc" * n, b"a" * n], ranks)
        assert len(one) == 1 and len(other) >= 1 and (one == mixed).all() and not set(one.tolist()) & set(other.tolist())
