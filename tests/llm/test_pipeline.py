"""The stages of the corpus pipeline against brute force."""

import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq

import corpus_pipeline
from lakeloom.llm import decontam


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(900)]
    texts = [[rng.choice(words) for _ in range(rng.randint(60, 240))] for _ in range(60)]
    for own in texts[:30]:
        for edits in (1, 2, 3, 5):
            copy = list(own)
            for k in rng.sample(range(len(copy)), edits):
                copy[k] = "changed"
            texts.append(copy)
    hot = texts[0]
    texts += [[w if k != j else "other" for k, w in enumerate(hot)] for j in range(40)]
    table = [" ".join(t) for t in texts] + [" ".join(texts[1]).upper(), " ".join(texts[1]), None, "", " ", "one two", "ONE  two"]
    sets, root = [shingles(t) for t in table], list(range(len(table)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if not a and not b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(table)], "doc_id long, text string, lang string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(root))
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
    odd = spark.createDataFrame([(None, "a b", "en"), (4, "a b", "en"), (None, "c d", "en")], docs.schema)
    assert sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, odd, "").collect()) == [(0, "c d"), (4, "a b")]


def test_verbatim_items_are_found_whatever_the_basis_keeps():
    read = lambda name: pq.read_table(f"/root/testdata/sf0.1/{name}.parquet").to_pylist()
    items = decontam.Items([(r["item_id"], r["text"]) for r in read("benchmark")])
    texts = [r["text"] for r in read("documents")]
    plain = lambda text: b" " + b" ".join(decontam.words_of(text)) + b" "
    wanted = [plain(r["text"]) for r in read("benchmark")]
    verbatim = {(d, i) for d, text in enumerate(map(plain, texts)) for i, item in enumerate(wanted) if item in text}
    seen = np.zeros(len(items.known))
    for own in items.encode(texts):
        seen[np.unique(own[own >= 0])] += 1
    idf = np.log((len(texts) + 1) / (seen + 1)) + 0.05
    search = decontam.Search(items, idf, np.eye(len(idf), decontam.RANK))
    found = {(a + d, i) for a in range(0, len(texts), 500) for d, i, *_ in search.leaks(texts[a : a + 500])}
    assert len(items.segments) > decontam.RANK and len(verbatim) > 200 and verbatim <= found


KINDS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, rest_id int, cut string"


def corpus():
    """Two languages, near copies, a repeated passage, a benchmark item, rejects, null and repeated ids, clashing names."""
    rng = random.Random(8)
    tongue = {
        "en": "the of and to in that was his with for this from river stone winter market garden letter".split(),
        "de": "der die das und nicht mit einer fluss steine winterzeit markt garten briefe wurde dass".split(),
    }
    made = []
    for k in range(40):
        lang = "en" if k % 2 else "de"
        made.append((lang, [f"{rng.choice(tongue[lang])}{rng.choice(['', '', 's', 'er'])}" for _ in range(rng.randint(60, 160))]))
    item = " ".join(made[3][1][10:50])
    for k in (4, 5, 6):
        copy = list(made[k][1])
        copy[20] = copy[40] = "und" if made[k][0] == "de" else "the"
        made.append((made[k][0], copy))
    passage = made[7][1][:30]
    made += [(made[7][0], [rng.choice(tongue["en"]) for _ in range(70)] + passage + [rng.choice(tongue["en"]) for _ in range(70)]) for _ in range(3)]
    rows = [(k, " ".join(words), lang) for k, (lang, words) in enumerate(made)]
    rows += [(1, rows[1][1], "en"), (1, rows[9][1], "en"), (None, rows[10][1], "de"), (None, " ".join(rng.choice(tongue["en"]) for _ in range(90)), None),
             (None, " ".join(rng.choice(tongue["de"]) for _ in range(90)), None), (90, None, None), (91, "", "en"), (92, "12 34 !", "en")]
    return [(d, t, lang, f"s{k}", len(t or ""), 0.5, "x", k, "clash") for k, (d, t, lang) in enumerate(rows)], [(0, item + "."), (1, None)]


def kept_by(rows, least=80):
    """Brute force of near copies: rows of each group's smallest (doc_id, text)."""
    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    groups = {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(rows[k])
    return groups.values()


def cut_by(rows):
    """Brute force of repeats: bytes of 50-byte strings that start in a row with a smaller doc_id go, null counts as largest."""
    rank = lambda r: (r.doc_id is None, r.doc_id or 0)
    out = {}
    for r in rows:
        text = (r.text or "").encode()
        earlier = b"\0".join((o.text or "").encode() for o in rows if rank(o) < rank(r))
        gone = [False] * len(text)
        for a in range(len(text) - 49):
            if text[a : a + 50] in earlier:
                gone[a : a + 50] = [True] * 50
        out[r.rest_id] = bytes(b for b, g in zip(text, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages_and_run_equal_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, items = corpus()
    spark.createDataFrame(rows, KINDS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, columns, sf_dir = spark.read.parquet(f"{tmp_path}/documents.parquet"), None, str(tmp_path)
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    def after(name, given):
        found = stages[name](spark, given, sf_dir)
        found.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    sure = after("language", docs)
    assert sure.columns == columns and dict(sure.dtypes) == dict(docs.dtypes)
    by_row, found = {r[7]: r for r in rows}, {r.rest_id: r for r in sure.collect()}
    assert set(by_row) - set(found) == {k for k, r in by_row.items() if r[0] in (90, 91, 92)}
    assert all(r.text == by_row[k][1] and r.source == by_row[k][3] and r.lang == (by_row[k][2] or r.lang) for k, r in found.items())

    apart = after("near_duplicates", sure)
    left = apart.collect()
    assert apart.columns == columns
    for group in kept_by(list(found.values())):
        mine = [r for r in left if r in group]
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert len({(r.doc_id, r.text) for r in mine}) == 1 and mine[0].doc_id == (min(ids) if ids else None)

    short = after("repeats", apart)
    assert short.columns == columns
    expected = {k: t for k, t in cut_by(left).items() if t.strip()}
    assert {r.rest_id: r.text for r in short.collect()} == expected
    assert all(r.n_chars == len(r.text) and r.cut == "clash" for r in short.collect())

    clean = after("decontamination", short)
    words = lambda t: " ".join(w.decode() for w in decontam.words_of(t))
    assert {r.rest_id for r in clean.collect()} == {k for k, t in expected.items() if words(items[0][1]) not in words(t)} != set(expected)

    packed = after("packing", clean).collect()
    tok = Tokenizer.from_file(corpus_pipeline.tokenizer_path("byte_bpe_50k.json"))
    ids = [(r.doc_id, [*tok.encode(r.text, add_special_tokens=False).ids, 2]) for r in clean.collect()]
    crc = lambda own: zlib.crc32(np.array(own, "<u4"))
    assert all(len(own) <= 1024 for _, own in ids)
    assert sorted((r.doc_id or -1, r.length, r.ids_crc32) for r in packed) == sorted((d or -1, len(own), crc(own)) for d, own in ids)
    sizes = {}
    for r in packed:
        sizes.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sizes.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id or -1, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id or -1, r.length, r.ids_crc32) for r in packed)


def test_stages_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], KINDS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_what_a_stage_keeps_goes_when_the_next_begins(spark):
    docs = spark.createDataFrame([(k, f"the river and the stone of number {k} " * 9, "en") for k in range(30)], "doc_id long, text string, lang string")
    corpus_pipeline.near_duplicates(spark, docs, "").count()
    made = [path for path, _ in corpus_pipeline._LEFT if os.path.exists(path)]
    assert len(made) > 3
    corpus_pipeline.pack(spark, docs, "").count()
    assert not any(map(os.path.exists, made))
