"""Benchmark leaks in documents by latent semantic cosines and shared weighted words, checked word by word.

Passages are PASSAGE words long and overlap by half; benchmark items are cut into SEGMENT-word
segments, each of which fits into one passage wholly. Both become TF-IDF vectors over the words of the
benchmark, with document frequencies of the whole corpus. A randomised SVD gives the latent
space: the product of the Gram matrix with a thin random matrix is summed over partitions,
made orthogonal, and repeated. It is fitted on the segments and on all documents, with as much weight
for the segments as passages as there are documents. Every passage is projected into it, and pairs with a
cosine above NEAR are candidates. As no bounded rank keeps every segment, so are, whatever their cosine, all
pairs that share OVERLAP of the segment's words by weight. They are found by the segment's heaviest words, of which
such a passage must have one. A candidate is a leak if the longest common subsequence of the item's
words with the words around the passage covers LEAK of the item and its last sentence, the answer,
is there for ANSWER of its words, or if it covers SURE of the item alone. Before that, stretches of text that
do not hold LEAK of an item's words in any order are passed over; no leak can be in them.

Items are handled in blocks of ITEMS, so what the tasks get is bounded at any benchmark size. Null
and empty texts and items, and items without words, match nothing; rows with equal ids are
separate; other columns are ignored by the search and kept by the filter; empty tables give no leaks.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import staged
from lakeloom.llm.packed import packed, unpacked
from lakeloom.llm.tokens import slices

#: Words of a product in dense columns, passages of a product, of a search, their pairs with segments, half passages of a stretch and bytes of text that are worked on at once:
#: what they need stays in a core's cache, and what a task holds does not grow with its batches.
DENSE, FACTORS, ROWS, PAIRS, STRETCH, SLICE = 512, 1024, 512, 4096, 8, 1 << 20
PASSAGE, SEGMENT, RANK, ROUNDS, ITEMS = 48, 24, 96, 2, 500
NEAR, OVERLAP, LEAK, ANSWER, SURE = 0.4, 0.4, 0.6, 0.5, 0.8
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in bytes(range(256)).lower())
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def common_words(item: list[int], region: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of the item."""
    where: dict[int, int] = {}
    for k, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << k
    row, full = 0, (1 << len(item)) - 1
    for w in region.tolist():
        hit = where.get(w)
        if hit:
            both = row | hit
            row = both & ~(both - (row << 1 | 1)) & full
    return row.bit_count()


class Items:
    """One block of the benchmark: words, segments, answers."""

    def __init__(self, rows: list[tuple[int, str]]):
        split = [(i, words_of(t), t) for i, t in rows]
        split = [(i, w, t) for i, w, t in split if w]
        self.ids = [i for i, _, _ in split]
        self.known: dict[bytes, int] = {}
        for _, words, _ in split:
            for w in words:
                self.known.setdefault(w, len(self.known))
        self.words = [[self.known[w] for w in words] for _, words, _ in split]
        self.answers = []
        for _, words, text in split:
            last = words_of(_SENTENCE.split(text.strip())[-1])
            self.answers.append({self.known[w] for w in (last if len(last) >= 3 else words[-5:])})
        self.segments: list[tuple[int, int]] = []  # item, first word
        for k, words in enumerate(self.words):
            for a in range(0, max(1, len(words) - SEGMENT + 1), SEGMENT // 2):
                self.segments.append((k, a))
            if len(words) > SEGMENT and self.segments[-1][1] + SEGMENT < len(words):
                self.segments.append((k, len(words) - SEGMENT))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Word numbers of texts; -1 for words outside the benchmark."""
        get, out = self.known.get, []
        for t in texts:
            words = words_of(t)
            out.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
        return out


class Passages:
    """Sparse vectors of the passages of some texts; passages without a benchmark word are left out."""

    def __init__(self, coded: list[np.ndarray], size: int):
        step = PASSAGE // 2
        lengths = np.array([len(c) for c in coded], np.int64)
        counts = np.maximum(1, -(-(lengths - step) // step))
        first = np.cumsum(counts) - counts
        flat = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(coded)), lengths)
        at = np.arange(len(flat)) - (np.cumsum(lengths) - lengths)[doc]
        hit = flat >= 0
        doc, at, word = doc[hit], at[hit], flat[hit]
        half = at // step  # a word is in the passage that starts at its half and in the one before
        own = [(half < counts[doc], half), (half > 0, half - 1)]
        passage = np.concatenate([first[doc[ok]] + p[ok] for ok, p in own])
        word = np.concatenate([word[ok] for ok, _ in own])
        key, times = np.unique(passage * size + word, return_counts=True)
        passage, self.word, self.times = key // size, key % size, times
        self.used, self.rows = np.unique(passage, return_inverse=True)
        self.starts = np.searchsorted(self.rows, np.arange(len(self.used)))
        self.doc = np.searchsorted(first, self.used, "right") - 1
        self.place = (self.used - first[self.doc]) * step

    def weights(self, idf: np.ndarray) -> np.ndarray:
        return ((1 + np.log(self.times)) * idf[self.word]).astype(np.float32)


def times_matrix(word: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int, often: np.ndarray, column: np.ndarray, matrix: np.ndarray):
    """``n`` sparse rows by a dense matrix, words ``often`` in dense columns; also these columns and the entries outside them."""
    at = column[word]
    many = at >= 0
    dense = np.zeros((n, len(often)), np.float32)
    dense[row[many], at[many]] = weight[many]
    made = dense @ matrix[often]
    word, row, weight = word[~many], row[~many], weight[~many, None]
    if len(word):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        made[row[first]] += np.add.reduceat(weight * matrix[word], first)
    return made, dense, (word, row, weight)


def columns_of(often: np.ndarray, size: int) -> np.ndarray:
    """Dense column of each word, or -1."""
    column = np.full(size, -1, np.int64)
    column[often] = np.arange(len(often))
    return column


def add_gram(entries: list[np.ndarray], idf: np.ndarray, often: np.ndarray, matrix: np.ndarray, out: np.ndarray) -> None:
    """Add passages' Gram matrix by a dense ``matrix`` to ``out``: words ``often`` in dense columns, a bounded number of passages at a time."""
    words, times, starts = entries
    column = columns_of(often, len(matrix))
    edges = np.append(starts, len(words)).astype(np.int64)
    for a in range(0, len(starts), FACTORS):
        b = min(a + FACTORS, len(starts))
        word = words[edges[a] : edges[b]].astype(np.int64)
        row = np.repeat(np.arange(b - a), np.diff(edges[a : b + 1]))
        weight = ((1 + np.log(times[edges[a] : edges[b]])) * idf[word]).astype(np.float32)
        made, dense, (word, row, weight) = times_matrix(word, row, weight, b - a, often, column, matrix)
        if len(word):
            order = np.argsort(word, kind="stable")
            some, first = np.unique(word[order], return_index=True)
            out[some] += np.add.reduceat(weight[order] * made[row[order]], first)
        out[often] += dense.T @ made


class Search:
    """Candidates and checks for one block of items, with the fitted space."""

    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray):
        self.items, self.idf, self.basis = items, idf, basis.astype(np.float32)
        queries = np.zeros((len(items.segments), len(idf)), np.float32)
        for row, (k, a) in enumerate(items.segments):
            some, n = np.unique(items.words[k][a : a + SEGMENT], return_counts=True)
            queries[row, some] = (1 + np.log(n)) * idf[some]
        self.present = queries > 0
        self.weight = idf.astype(np.float32)
        self.needed = OVERLAP * (self.present @ self.weight)
        self.lead, self.leads = self._leading()
        latent = queries @ self.basis
        self.queries = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        self.often = np.argsort(idf, kind="stable")[:DENSE]
        self.column = columns_of(self.often, len(idf))
        self.firsts = np.flatnonzero(np.diff([k for k, _ in items.segments], prepend=-1))  # segments of an item follow each other
        self.counts = np.zeros((len(idf), len(items.words)), np.float32)
        for k, words in enumerate(items.words):
            np.add.at(self.counts[:, k], words, 1)
        self.sizes = np.array([len(words) for words in items.words])

    def _leading(self) -> tuple[np.ndarray, np.ndarray]:
        """Segments by leading word, and where each word's begin: without one of a segment's leading words a passage has less than OVERLAP of it."""
        word, segment = [], []
        for row, there in enumerate(self.present):
            some = np.flatnonzero(there)
            some = some[np.argsort(-self.weight[some], kind="stable")]
            left = self.weight[some][::-1].cumsum()[::-1]  # of this word and all behind it
            some = some[left >= self.needed[row] * (1 - 1e-5)]
            word.append(some)
            segment.append(np.full(len(some), row))
        words = np.concatenate([np.zeros(0, np.int64), *word])
        order = np.argsort(words, kind="stable")
        return np.concatenate([np.zeros(0, np.int64), *segment])[order], np.searchsorted(words[order], np.arange(len(self.idf) + 1))

    def _candidates(self, rows: Passages, edges: np.ndarray):
        """Passages and segments of which they have OVERLAP by weight."""
        for a in range(0, len(rows.used), ROWS):
            b = min(a + ROWS, len(rows.used))
            i, j = edges[a], edges[b]
            begin = self.leads[rows.word[i:j]]
            n = self.leads[rows.word[i:j] + 1] - begin
            spots = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.unique(self.lead[spots] * (b - a) + np.repeat(rows.rows[i:j] - a, n))  # by segment, so that its weights are at hand
            for k in range(0, len(both), PAIRS):
                segment, near = np.divmod(both[k : k + PAIRS], b - a)
                near += a
                sizes = edges[near + 1] - edges[near]
                begins = np.cumsum(sizes) - sizes
                seen = rows.word[np.repeat(edges[near] - begins, sizes) + np.arange(int(sizes.sum()))]
                shared = np.add.reduceat(self.present[np.repeat(segment, sizes), seen] * self.weight[seen], begins)
                ok = shared >= self.needed[segment]
                yield from zip(near[ok].tolist(), segment[ok].tolist())

    def latent(self, rows: Passages, weights: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """All passages in the latent space, of length one."""
        parts = [np.zeros((0, self.basis.shape[1]), np.float32)]
        for a in range(0, len(rows.used), FACTORS):
            b = min(a + FACTORS, len(rows.used))
            i, j = edges[a], edges[b]
            parts.append(times_matrix(rows.word[i:j], rows.rows[i:j] - a, weights[i:j], b - a, self.often, self.column, self.basis)[0])
        latent = np.concatenate(parts)
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def _holding(self, coded: list[np.ndarray], rows: Passages) -> tuple[np.ndarray, np.ndarray]:
        """Whether stretches of text have LEAK of each item's words, and the stretch around each passage and its region."""
        step = PASSAGE // 2 * STRETCH
        lengths = np.array([len(c) for c in coded], np.int64)
        counts = lengths // step + 1
        first = np.cumsum(counts) - counts
        flat = np.concatenate([np.zeros(0, np.int64), *coded])
        doc = np.repeat(np.arange(len(coded)), lengths)
        at = np.arange(len(flat)) - (np.cumsum(lengths) - lengths)[doc]
        hit = flat >= 0
        doc, at, word = doc[hit], at[hit], flat[hit]
        reach = int(self.sizes.max())
        low = np.maximum(-(-(at - step - PASSAGE - reach + 1) // step), 0)  # the stretches a word is in: from `reach` words before the first passage to as many behind the last
        high = np.minimum((at + reach) // step, counts[doc] - 1)
        layers = []
        for k in range(int((high - low).max(initial=-1)) + 1):
            own = low + k <= high
            layers.append(((first[doc] + low + k)[own], word[own]))
        total, matrix = int(counts.sum()), self.counts[self.often]
        parts = [np.zeros((0, len(self.sizes)), bool)]
        for a in range(0, total, FACTORS):
            there = np.zeros((min(FACTORS, total - a), len(self.often)), np.float32)
            rest = [np.zeros(0, np.int64)]
            for stretch, words in layers:
                i, j = np.searchsorted(stretch, (a, a + FACTORS))
                row, own = stretch[i:j] - a, words[i:j]
                column = self.column[own]
                many = column >= 0
                there[row[many], column[many]] = 1
                rest.append(row[~many] * len(self.idf) + own[~many])
            some = there @ matrix
            row, own = np.divmod(np.unique(np.concatenate(rest)), len(self.idf))
            if len(row):
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                some[row[begin]] += np.add.reduceat(self.counts[own], begin)
            parts.append(some >= LEAK * self.sizes - 1e-3)
        return np.concatenate(parts), first[rows.doc] + rows.place // step

    def by_cosine(self, coded: list[np.ndarray], rows: Passages, latent: np.ndarray):
        """Passages and segments with a cosine above NEAR, the nearest of an item's segments, where there is LEAK of the item's words."""
        holding, stretch = self._holding(coded, rows)
        last = np.append(self.firsts[1:], len(self.queries))
        for a in range(0, len(rows.used), ROWS):
            cosine = self.queries @ latent[a : a + ROWS].T
            near, item = np.nonzero(holding[stretch[a : a + ROWS]])
            if not len(near):
                continue
            n = last[item] - self.firsts[item]
            begin = np.cumsum(n) - n
            value = cosine[np.repeat(self.firsts[item] - begin, n) + np.arange(int(n.sum())), np.repeat(near, n)]
            pair = np.repeat(np.arange(len(near)), n)
            order = np.lexsort((-value, pair))[begin]
            for k in np.flatnonzero(value[order] > NEAR).tolist():
                yield a + int(near[k]), int(self.firsts[item[k]] + order[k] - begin[k])

    def _cosine(self, words: np.ndarray, weights: np.ndarray, segment: int) -> float:
        """Of a passage and a segment in the latent space."""
        latent = weights @ self.basis[words]
        return float(self.queries[segment] @ latent / max(float(np.linalg.norm(latent)), 1e-9))

    def leaks(self, texts: list[str | None]) -> list[tuple[int, int, float, float]]:
        """(text, item number, share of the item found, cosine), the best for each text and item."""
        coded = self.items.encode(texts)
        rows = Passages(coded, len(self.idf))
        edges = np.append(rows.starts, len(rows.word))
        if not len(rows.used):
            return []
        weights = rows.weights(self.idf)
        latent = self.latent(rows, weights, edges)
        best: dict[tuple[int, int], tuple[float, float]] = {}
        checked: dict[tuple[int, int], float] = {}
        for p, q in chain(self.by_cosine(coded, rows, latent), self._candidates(rows, edges)):
            item = self.items.segments[q][0]
            doc = int(rows.doc[p])
            share = checked.get((p, item))
            if share is None:
                share = checked[p, item] = self._share(coded[doc], int(rows.place[p]), item)
            if share:
                old = best.get((doc, item), (0.0, 0.0))
                best[doc, item] = max(old, (share, self._cosine(rows.word[edges[p] : edges[p + 1]], weights[edges[p] : edges[p + 1]], q)))
        return [(doc, item, share, cosine) for (doc, item), (share, cosine) in best.items()]

    def _share(self, coded: np.ndarray, place: int, item: int) -> float:
        """Share of an item that is around a passage, 0 where that is no leak."""
        words = self.items.words[item]
        region = coded[max(0, place - len(words)) : place + PASSAGE + len(words)]
        there = set(region.tolist())
        if sum(w in there for w in words) < LEAK * len(words):  # no subsequence can be long enough
            return 0.0
        share = common_words(words, region) / len(words)
        answer = self.items.answers[item]
        return share if share >= SURE or share >= LEAK and len(answer & there) >= ANSWER * len(answer) else 0.0


def fit(docs: DataFrame, items: Items) -> Search:
    """Document frequencies of all documents, then the latent basis."""
    size = len(items.known)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(items)

    def encode(batches):
        """Passages as numbers, so that texts are split once, and in how many texts each word is."""
        own = held.value
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            coded = own.encode(batch.column("text").to_pylist())
            found = Passages(coded, size)
            words, n = np.unique(np.concatenate([np.unique(c[c >= 0]) for c in coded]), return_counts=True)
            rows = packed(found.word.astype(np.uint32), found.times.astype(np.uint8), found.starts.astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.binary()), pa.array([packed(words.astype(np.uint32), n.astype(np.uint32))], pa.binary())], names=["rows", "words"])

    coded = staged(docs.select("text").mapInArrow(encode, "rows binary, words binary"), "passages")

    def frequencies(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column("words"):
                words, n = unpacked(data.as_py())
                total[words] += n
        n = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(total[n], pa.int64())], names=["word", "n"])

    found = coded.select("words").mapInArrow(frequencies, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    total = docs.count()
    seen = np.zeros(size)
    seen[found["word"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    idf = np.log((total + 1) / (seen + 1)) + 0.05
    often = np.argsort(-seen, kind="stable")[:DENSE]
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((size, min(RANK, size))))[0]
    for _ in range(ROUNDS):
        thin = spark.sparkContext.broadcast(basis.astype(np.float32))

        def product(batches, thin=thin):
            out = np.zeros(thin.value.shape)
            for batch in batches:
                for data in batch.column("rows"):
                    add_gram(unpacked(data.as_py()), idf, often, thin.value, out)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out)) // 256, pa.int32()), pa.array([r.tobytes() for r in out], pa.binary()), pa.array(np.arange(len(out)), pa.int32())], names=["part", "row", "word"])

        def together(_, rows):
            sums: dict[int, np.ndarray] = {}
            for word, row in zip(rows.column("word").to_pylist(), rows.column("row")):
                sums[word] = sums.get(word, 0) + np.frombuffer(row.as_py())
            return pa.table({"word": pa.array(list(sums), pa.int32()), "row": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

        summed = coded.select("rows").mapInArrow(product, "part int, row binary, word int").groupBy("part").applyInArrow(together, "word int, row binary").collect()  # a thin row for each benchmark word
        gram = np.zeros(basis.shape)
        for r in summed:
            gram[r.word] = np.frombuffer(r.row)
        gram += _segments_gram(items, idf, basis, total)
        basis = np.linalg.qr(gram)[0]
    return Search(items, idf, basis)


def _segments_gram(items: Items, idf: np.ndarray, basis: np.ndarray, weight: int) -> np.ndarray:
    """The segments' part of the product; together they weigh as much as ``weight`` passages."""
    rows = np.zeros((len(items.segments), len(idf)))
    for row, (k, a) in enumerate(items.segments):
        some, n = np.unique(items.words[k][a : a + SEGMENT], return_counts=True)
        rows[row, some] = (1 + np.log(n)) * idf[some]
    return rows.T @ (rows @ basis) * max(1.0, weight / max(1, len(rows)))


def item_blocks(benchmark: DataFrame):
    """Blocks of ITEMS items at most, in order of their ids."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    if rows.count() <= ITEMS:
        blocks = [rows]
    else:
        parts = -(-rows.count() // (ITEMS // 2))
        blocks = [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]
    for block in blocks:
        items = Items([(r.item_id, r.text) for r in block.collect()])
        if items.segments:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, share, cosine`` of every document with an item's text."""
    kinds = "doc_id long, item_id long, share double, cosine double"
    out = None
    for items in item_blocks(benchmark):
        search = docs.sparkSession.sparkContext.broadcast(fit(docs, items))

        def run(batches, search=search):
            for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
                found = search.value.leaks(batch.column("text").to_pylist())
                ids = batch.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[d] for d, *_ in found], pa.int64()), pa.array([search.value.items.ids[i] for _, i, *_ in found], pa.int64()),
                    pa.array([s for *_, s, _ in found], pa.float64()), pa.array([c for *_, c in found], pa.float64())], names=["doc_id", "item_id", "share", "cosine"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], kinds) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no item's text."""
    for items in item_blocks(benchmark):
        search = docs.sparkSession.sparkContext.broadcast(fit(docs, items))

        def run(batches, search=search):
            for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
                bad = np.zeros(batch.num_rows, bool)
                bad[[d for d, *_ in search.value.leaks(batch.column("text").to_pylist())]] = True
                yield batch.filter(pa.array(~bad))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
