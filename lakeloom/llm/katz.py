"""Katz backoff language model over words, trained and evaluated with Spark.

Order two over all training words; what never occurred in training is one more word, so the model
covers any text and sums to one. Seen pairs get their Good-Turing discounted share; what is left of a
history goes to the unigrams of the words not seen after it, by a backoff weight that makes the
whole sum to one exactly. A token is evaluated recursively: pair, else weight times unigram. The
unigrams are those of the base score, so a document's score is its base score plus, for every pair,
either the log of its share less that of the unigram, or the log of the weight.

Counts of words and of pairs are stored in tables partitioned by hash. The VOCABULARY most frequent
words have numbers; tasks get their counts, totals and weights whole, and the pairs that are more
than one in HOT_PAIRS of all (at most HOT_PAIRS of them). That is a cache and changes no result:
pairs of two frequent words lie by pair, all others in the bucket of their rare word, two rare ones
in that of the first. Blocks of documents resolve what they can themselves and ask the tables for
the rest, so no frequent word or pair meets in one task. Words are known by 64-bit hashes; the
chance that any two of a billion words share one is about 3 %.

Null and empty texts are the end token alone. Documents whose crc32 fold is 0 do not train. Equal
doc_ids are separate rows; with no training row all words are unknown. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import fold_of, staged
from lakeloom.llm.packed import packed, summed, unpacked

VOCABULARY, HOT_PAIRS, DISCOUNTED, ADD = 50_000, 100_000, 5, 0.1
BLOCK_BYTES, KEYS_PER_BUCKET = 8 << 20, 1 << 21
_BLOB = "bucket int, data binary"


def _blob(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary()))], names=["bucket", "data"])


class Block:
    """Tokens of some documents as hashes; the end token has hash 0."""

    def __init__(self, texts: list[str | None]):
        import xxhash

        known: dict[bytes, int] = {}
        parts, self.sizes = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            words = text.encode().lower().split() if text else []
            for w in set(words):
                if w not in known:
                    known[w] = len(known) + 1
            parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
            self.sizes[k] = len(words) + 1
        self.local = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.hashes = np.zeros(len(known) + 1, np.uint64)
        self.hashes[1:] = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
        self.hashes[1:] |= np.uint64(1)  # never that of the end
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes


def _blocks(batches, *names: str):
    """Lists of columns of about BLOCK_BYTES of text, ``text`` first."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("text", *names))):
            held.append(row)
            size += len(row[0] or "")
            if size >= BLOCK_BYTES:
                yield list(zip(*held))
                held, size = [], 0
    if held:
        yield list(zip(*held))


def _dealt(keys: np.ndarray, buckets: int, *values: np.ndarray):
    """(bucket, keys, values) of sorted keys."""
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(ends)):
        own = order[ends[k] : ends[k + 1]]
        yield int(k), keys[own], *(v[own] for v in values)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


class Vocabulary:
    """Ids of frequent words: 0 is the end, RARE and START come last."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, all_tokens: int, all_words: int):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order].astype(np.float64)
        self.size = len(hashes)
        self.rare, self.start = self.size, self.size + 1
        self.tokens, self.words = all_tokens, all_words
        rest = all_tokens - self.counts.sum()
        classes = np.append(self.counts, rest)
        self.unigram = (classes + ADD) / (all_tokens + ADD * len(classes))
        # shares within the rare class: counts plus ADD over this
        self.rare_total = rest + ADD * (all_words - int((self.counts > 0).sum()) + 1)
        self.base_total = all_tokens + ADD * (all_words + 1)
        self.base = (self.counts + ADD) / self.base_total

    def ids(self, block: Block) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, block.hashes), max(0, self.size - 1))
        hit = self.hashes[at] == block.hashes if self.size else np.zeros(len(block.hashes), bool)
        return np.where(hit, at, self.rare)[block.local]

    def pairs(self, block: Block, ids: np.ndarray) -> np.ndarray:
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[block.first] = self.start
        return before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)


def _table(blobs: DataFrame, label: str) -> DataFrame:
    """Counts by key: one row of arrays for each bucket."""

    def total(_, rows):
        held = [unpacked(d.as_py()) for d in rows.column("data")]
        keys, counts = summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1].astype(np.uint64) for h in held]))
        return pa.table({"bucket": rows.column("bucket").slice(0, 1), "data": pa.array([packed(keys, counts)], pa.binary())})

    return staged(blobs.groupBy("bucket").applyInArrow(total, _BLOB), label)


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Table of training words (end included) with their counts."""

    def count(batches):
        for texts, in _blocks(batches):
            block = Block(list(texts))
            n = np.bincount(block.local, minlength=len(block.hashes))
            order = np.argsort(block.hashes)
            rows = [(k, packed(keys, c)) for k, keys, c in _dealt(block.hashes[order], buckets, n[order].astype(np.uint32))]
            yield _blob(rows)

    return _table(docs.select("text").mapInArrow(count, _BLOB), "words")


def vocabulary(words: DataFrame, size: int) -> Vocabulary:
    def top(batches):
        for batch in batches:
            for data in batch.column("data"):
                keys, counts = unpacked(data.as_py())
                best = np.lexsort((keys, -counts.astype(np.int64)))[:size]
                end = np.flatnonzero(keys == 0)
                best = np.union1d(best, end)
                share = np.zeros((len(best), 2), np.int64)
                if len(best):
                    share[0] = int(counts.sum()), len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys[best].view(np.int64)), pa.array(counts[best].astype(np.int64)), pa.array(share[:, 0]), pa.array(share[:, 1])], names=["key", "n", "tokens", "words"])

    found = staged(words.select("data").mapInArrow(top, "key long, n long, tokens long, words long"), "frequent")
    sums = found.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    best = found.orderBy((F.col("key") == 0).desc(), F.desc("n"), "key").limit(size).select("key", "n").toPandas()  # bounded by ``size``
    return Vocabulary(best["key"].to_numpy(np.int64).view(np.uint64), best["n"].to_numpy(np.int64), int(sums.tokens or 0), int(sums.words or 0))


def pair_counts(docs: DataFrame, vocab, buckets: int) -> DataFrame:
    """Table of training pairs of classes with their counts: a small model, in which all words outside the vocabulary are one."""

    def count(batches):
        words = vocab.value
        for texts, in _blocks(batches):
            block = Block(list(texts))
            keys, n = np.unique(words.pairs(block, words.ids(block)), return_counts=True)
            yield _blob([(k, packed(own, c)) for k, own, c in _dealt(keys, buckets, n.astype(np.uint32))])

    return _table(docs.select("text").mapInArrow(count, _BLOB), "pairs")


_KINDS = [f"k{r}" for r in range(1, DISCOUNTED + 2)]
_SUMS = [*_KINDS, "total", "mass"]
_SUM_ROWS = "h long, " + ", ".join(f"{c} double" for c in _SUMS)


def _sums(spot: np.ndarray, size: int, n: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """By history: pairs counted 1 .. DISCOUNTED + 1 times, their counts, and the unigram shares of their words."""
    n = n.astype(np.int64)
    kinds = [np.bincount(spot, n == r, size) for r in range(1, DISCOUNTED + 2)]
    return [*kinds, np.bincount(spot, n, size), np.bincount(spot, share, size)]


def _sum_rows(history: np.ndarray, n: np.ndarray, share: np.ndarray) -> pa.RecordBatch:
    some, spot = np.unique(history, return_inverse=True)
    cols = _sums(spot, len(some), n, share)
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(c, pa.float64()) for c in cols)], names=["h", *_SUMS])


def _weights(sums: list[np.ndarray], discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a history's counts are divided by, and its backoff weight (1 for one never seen)."""
    *kinds, total, mass = sums
    lost = sum(r * (1 - discount[r]) * kinds[r - 1] for r in range(1, DISCOUNTED + 1))
    # a history with nothing to discount gives its unseen words the weight of one more token
    whole = total + (lost <= 1e-9)
    left = 1 - (total - lost) / whole
    free = 1 - mass
    weight = np.where(total > 0, left / np.maximum(free, 1e-300), 1.0)
    full = (total > 0) & (free <= 1e-9)  # every class was seen: nothing to back off to
    whole[full], weight[full] = (total - lost)[full], 0.0
    return whole, weight


class Backoff:
    """Discounts, history totals and backoff weights, all bounded by the vocabulary, and the most frequent pairs.

    ``rest`` holds the sums of the pairs with words outside the vocabulary; without it ``pairs`` are of classes.
    """

    def __init__(self, pairs: DataFrame, vocab, hot_pairs: int, rest: DataFrame | None = None):
        words: Vocabulary = vocab.value
        classes = rest is None

        def sums(batches):
            share = vocab.value.unigram if classes else vocab.value.base
            for batch in batches:
                for data in batch.column("data"):
                    keys, counts = unpacked(data.as_py())
                    yield _sum_rows((keys >> np.uint64(32)).astype(np.int64), counts, share[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)])

        rows = pairs.select("data").mapInArrow(sums, _SUM_ROWS)
        if rest is not None:
            rows = rows.unionByName(rest)
        found = rows.groupBy("h").agg(*(F.sum(c).alias(c) for c in _SUMS)).toPandas()  # a row for each word of the vocabulary at most
        table = {c: np.zeros(words.start + 1) for c in _SUMS}
        for c in _SUMS:
            table[c][found["h"].to_numpy(np.int64)] = found[c].to_numpy()
        self.discount = good_turing([table[c].sum() for c in _KINDS])
        self.total, self.weight = _weights([table[c] for c in _SUMS], self.discount)
        least = max(2, int(table["total"].sum()) // hot_pairs + 1)

        def hot(batches):
            for batch in batches:
                for data in batch.column("data"):
                    keys, counts = unpacked(data.as_py())
                    big = counts >= least
                    yield pa.RecordBatch.from_arrays([pa.array(keys[big].view(np.int64)), pa.array(counts[big].astype(np.int64))], names=["key", "n"])

        often = pairs.select("data").mapInArrow(hot, "key long, n long").toPandas().sort_values("key")  # at most ``hot_pairs`` rows
        self.keys, self.counts = often["key"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)

    def seen(self, history: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 of the share of pairs that were counted n > 0 times."""
        kept = self.discount[np.minimum(n, DISCOUNTED + 1)]
        return np.log10(kept * n / self.total[history])

    def unseen(self, words: Vocabulary, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(self.weight[history], 1e-300)) + np.log10(words.unigram[word])


def good_turing(kinds: list[float]) -> np.ndarray:
    """Discount of counts 1 .. DISCOUNTED by the numbers of kinds counted r times; 1 beyond.

    Where those numbers are too irregular for a discount between 0 and 1, half a count is taken off.
    """
    out = np.ones(DISCOUNTED + 2)
    n = [0.0, *kinds]
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        out[r] = 0.0
        if n[r] and common < 1:
            out[r] = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        if not 0 < out[r] < 1:
            out[r] = (r - 0.5) / r
    return out


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ordered by bucket, the place of each key among them, and where buckets begin."""
    distinct, place = np.unique(keys, return_inverse=True)
    bucket = _bucket(distinct, buckets)
    order = np.argsort(bucket, kind="stable")
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    return distinct[order], at[place], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _two(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)


def _apart(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _found(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, -1 for those it lacks."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _times(table: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _found(table, keys)
    return np.where(at >= 0, counts[at] if len(counts) else 0, 0).astype(np.int64)


class Around:
    """The words of a block outside the vocabulary, and what stands before and after each of them."""

    def __init__(self, v: Vocabulary, block: Block, ids: np.ndarray):
        before, after = np.empty_like(ids), np.empty_like(ids)
        before[1:], after[:-1] = ids[:-1], ids[1:]
        before[block.first], after[block.first + block.sizes - 1] = v.start, v.rare
        self.at = np.flatnonzero(ids == v.rare)
        self.word = block.hashes[block.local[self.at]]
        self.doc = block.doc[self.at]
        self.before, self.after = before[self.at], after[self.at]  # the number of the class for a rare word and for none
        second = self.at[before[self.at] == v.rare]  # of two rare words
        self.first_word, self.second_word = block.hashes[block.local[second - 1]], block.hashes[block.local[second]]
        self.pair_doc = block.doc[second]


def all_pairs(docs: DataFrame, vocab, words: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Tables ``kind, bucket, data`` of all training pairs.

    Kind 0, buckets from 0: numbers of two frequent words, count. Kind 1, from ``buckets``: the words of a bucket,
    their counts, and (place of a rare word, number of a frequent one), count: first for the pairs that end with
    the rare word, then for those that begin with it. Kind 3: rare word, rare word, their pair's count, the second's count.
    """
    kinds = "kind int, bucket int, data binary"

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else ((), (), ()), (pa.int32(), pa.int32(), pa.binary()))], names=["kind", "bucket", "data"])

    def count(batches):
        v = vocab.value
        for texts, in _blocks(batches):
            block = Block(list(texts))
            ids = v.ids(block)
            keys = v.pairs(block, ids)
            high, low = _apart(keys)
            keys, n = np.unique(keys[(high != v.rare) & (low != v.rare)], return_counts=True)
            out = [(0, k, packed(own, c)) for k, own, c in _dealt(keys, buckets, n.astype(np.uint32))]
            around = Around(v, block, ids)
            own, place, edges = _by_bucket(around.word, buckets)
            sides = []
            for partner in (around.before, around.after):
                some = partner != v.rare
                sides.append(np.unique(_two(place[some], partner[some]), return_counts=True))
            seconds, at, second_edges = _by_bucket(around.second_word, buckets)
            order = np.lexsort((around.first_word, at))
            at, firsts = at[order], around.first_word[order]
            new = np.flatnonzero(np.concatenate([np.ones(int(len(at) > 0), bool), (at[1:] != at[:-1]) | (firsts[1:] != firsts[:-1])]))
            times = np.diff(np.append(new, len(at)))
            at, firsts = at[new], firsts[new]
            for k in np.flatnonzero(np.diff(edges)):
                parts = [own[edges[k] : edges[k + 1]]]
                for pairs, n in sides:
                    i, j = np.searchsorted(pairs, edges[k : k + 2].astype(np.uint64) << np.uint64(32))
                    parts += [pairs[i:j] - (np.uint64(edges[k]) << np.uint64(32)), n[i:j].astype(np.uint32)]
                out.append((1, buckets + int(k), packed(*parts)))
            for k in np.flatnonzero(np.diff(second_edges)):
                a, b = second_edges[k : k + 2]
                i, j = np.searchsorted(at, (a, b))
                out.append((2, buckets + int(k), packed(seconds[a:b], (at[i:j] - a).astype(np.uint32), firsts[i:j], times[i:j].astype(np.uint32))))
            yield rows(out)

    def total(_, parts, table):
        """Sums; the pairs of two rare words get the count of the second one and go on to the bucket of the first."""
        given = [(k, b, unpacked(d.as_py())) for k, b, d in zip(parts.column("kind").to_pylist(), parts.column("bucket").to_pylist(), parts.column("data"))]
        if not table.num_rows:
            keys, n = summed(np.concatenate([d[0] for *_, d in given]), np.concatenate([d[1].astype(np.uint64) for *_, d in given]))
            return pa.Table.from_batches([rows([(0, given[0][1], packed(keys, n))])])
        number = table.column("bucket")[0].as_py()
        keys, counts = unpacked(table.column("data")[0].as_py())
        sides = [([np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]) for _ in range(2)]
        two = [[np.zeros(0, np.uint64)] for _ in range(4)]
        for kind, _, d in given:
            place = np.searchsorted(keys, d[0])
            if kind == 1:
                for (pairs, times), own, n in zip(sides, d[1::2], d[2::2]):
                    high, low = _apart(own)
                    pairs.append(_two(place[high], low))
                    times.append(n.astype(np.uint64))
            else:
                for held, own in zip(two, (d[2], d[0][d[1]], d[3].astype(np.uint64), counts[place][d[1]].astype(np.uint64))):
                    held.append(own)
        around = [x for pairs, times in sides for x in summed(np.concatenate(pairs), np.concatenate(times))]
        out = [(1, number, packed(keys, counts, *around))]
        first, second, n, seconds = (np.concatenate(x) for x in two)
        order = np.lexsort((second, first))
        first, second, n, seconds = first[order], second[order], n[order], seconds[order]
        if len(first):
            new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
            n = np.add.reduceat(n, new)
            for k, own, *rest in _dealt(first[new], buckets, second[new], n, seconds[new]):
                out.append((2, buckets + k, packed(own, *rest)))
        return pa.Table.from_batches([rows(out)])

    dealt = docs.select("text").mapInArrow(count, kinds)
    placed = words.select((F.col("bucket") + buckets).alias("bucket"), "data")
    found = staged(dealt.groupBy("bucket").cogroup(placed.groupBy("bucket")).applyInArrow(total, kinds), "pairs")

    def together(_, parts):
        held = [unpacked(d.as_py()) for d in parts.column("data")]
        first, second, n, seconds = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((second, first))
        return pa.Table.from_batches([rows([(3, parts.column("bucket")[0].as_py(), packed(first[order], second[order], n[order], seconds[order]))])])

    return found.where("kind < 2"), staged(found.where("kind = 2").groupBy("bucket").applyInArrow(together, kinds), "rare-pairs")


def _rest(pairs: DataFrame, rare: DataFrame, vocab) -> DataFrame:
    """Sums by history of the pairs with rare words; rare histories are added up to one row, for the numbers of kinds."""

    def run(batches):
        v = vocab.value
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
                d = unpacked(data.as_py())
                if kind == 3:
                    yield _sum_rows(np.full(len(d[0]), v.rare), d[2], (d[3] + ADD) / v.base_total)
                else:
                    place, before = _apart(d[2])
                    yield _sum_rows(before, d[3], (d[1][place] + ADD) / v.base_total)
                    _, after = _apart(d[4])
                    yield _sum_rows(np.full(len(after), v.rare), d[5], v.base[after])

    return pairs.where("kind = 1").unionByName(rare).mapInArrow(run, _SUM_ROWS)


class Bucket:
    """Counts, pairs and histories of the rare words of a bucket."""

    def __init__(self, tables: dict[int, list[np.ndarray]], v: Vocabulary, m: Backoff):
        none = np.zeros(0, np.uint64)
        self.v, self.m = v, m
        self.keys, self.counts, self.before, self.n_before, self.after, self.n_after = tables.get(1, [none] * 6)
        first, second, n, seconds = tables.get(3, [none] * 4)
        place, after = _apart(self.after)
        own = np.searchsorted(self.keys, first)
        spot, share = np.concatenate([place, own]), np.concatenate([v.base[after], (seconds + ADD) / v.base_total])
        self.total, self.weight = _weights(_sums(spot, len(self.keys), np.concatenate([self.n_after, n]), share), m.discount)
        self.seconds, at = np.unique(second, return_inverse=True)
        self.second_base = np.zeros(len(self.seconds))
        self.second_base[at] = np.log10((seconds + ADD) / v.base_total)
        pairs = _two(own, at)
        order = np.argsort(pairs)
        self.pairs, self.n_pairs = pairs[order], n[order]

    def _shares(self, n, total, weight, base):
        """What a pair adds to the base score."""
        seen = n > 0
        kept = self.m.discount[np.minimum(n, DISCOUNTED + 1)]
        out = np.log10(np.maximum(weight, 1e-300))
        out[seen] = np.log10(kept[seen] * n[seen] / total[seen]) - base[seen]
        return out

    def answer(self, data: list[np.ndarray]) -> bytes:
        words, place, doc, before, after, pair_place, seconds, pair_doc = data
        v, m = self.v, self.m
        spot = _found(self.keys, words)
        known = spot >= 0
        counts = np.where(known, self.counts[spot] if len(self.keys) else 0, 0)
        total = np.where(known, self.total[spot] if len(self.keys) else 1.0, 1.0)
        weight = np.where(known, self.weight[spot] if len(self.keys) else 1.0, 1.0)
        base = np.log10((counts + ADD) / v.base_total)
        more = np.zeros(len(place))
        some = np.flatnonzero(before != v.rare)
        at, history = place[some], before[some].astype(np.int64)
        n = np.where(known[at], _times(self.before, self.n_before, _two(np.maximum(spot[at], 0), history)), 0)
        more[some] += self._shares(n, m.total[history], m.weight[history], base[at])
        some = np.flatnonzero(after != v.rare)
        at, word = place[some], after[some].astype(np.int64)
        n = np.where(known[at], _times(self.after, self.n_after, _two(np.maximum(spot[at], 0), word)), 0)
        more[some] += self._shares(n, total[at], weight[at], np.log10(v.base[word]))
        second = _found(self.seconds, seconds)
        both = known[pair_place] & (second >= 0)
        n = np.where(both, _times(self.pairs, self.n_pairs, _two(np.maximum(spot[pair_place], 0), np.maximum(second, 0))), 0)
        pair_base = self.second_base[second] if len(self.seconds) else np.zeros(len(second))
        pair_more = self._shares(n, total[pair_place], weight[pair_place], pair_base)
        docs, at = np.unique(np.concatenate([doc, pair_doc]), return_inverse=True)
        own, size = at[: len(doc)], len(docs)
        sums = np.bincount(own, base[place], size), np.bincount(at, np.concatenate([more, pair_more]), size)
        return packed(docs.astype(np.uint32), np.bincount(own, counts[place] > 0, size).astype(np.uint32), *sums)


def score(docs: DataFrame, folds: int = 10, size: int = VOCABULARY) -> DataFrame:
    """Every document's base score and its log10 probability under the model, whatever ``size`` of the cache."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold_of("doc_id", folds) == 0).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-int(letters) // 6 // KEYS_PER_BUCKET))  # about a word in six bytes
    words = word_counts(train, buckets)
    vocab = spark.sparkContext.broadcast(vocabulary(words, size))
    pairs, rare = all_pairs(train, vocab, words, buckets)
    backoff = spark.sparkContext.broadcast(Backoff(pairs.where("kind = 0"), vocab, HOT_PAIRS, _rest(pairs, rare, vocab)))

    def ask(batches):
        """Rows of kind 0: what a block knows of its documents; 1, 2: its questions about pairs of frequent words and about rare words."""
        from pyspark import TaskContext

        v, m = vocab.value, backoff.value
        for nth, (texts, doc_ids, held) in enumerate(_blocks(batches, "doc_id", "held_out")):
            part = TaskContext.get().partitionId()
            number = part << 24 | nth
            block, n_docs = Block(list(texts)), len(texts)
            ids = v.ids(block)
            known = ids != v.rare
            base = np.bincount(block.doc[known], np.log10(v.base)[ids[known]], n_docs)
            n_known = np.bincount(block.doc[known], minlength=n_docs)
            keys = v.pairs(block, ids)
            history, word = _apart(keys)
            both = known & (history != v.rare)
            keys, history, word, doc = keys[both], history[both], word[both], block.doc[both]
            at = _found(m.keys, keys)
            hot = at >= 0
            shares = np.bincount(doc[hot], m.seen(history[hot], m.counts[at[hot]]) - np.log10(v.base)[word[hot]], n_docs)
            out = _questions(1, number, keys[~hot], doc[~hot], buckets)
            around = Around(v, block, ids)
            own, place, edges = _by_bucket(np.concatenate([around.word, around.first_word]), buckets)
            order = np.argsort(place[: len(around.word)], kind="stable")
            one, doc, before, after = (x[order] for x in (place[: len(around.word)], around.doc, around.before, around.after))
            order = np.argsort(place[len(around.word) :], kind="stable")
            two, second, pair_doc = (x[order] for x in (place[len(around.word) :], around.second_word, around.pair_doc))
            for k in np.flatnonzero(np.diff(edges)):
                a, b = edges[k : k + 2]
                i, j = np.searchsorted(one, (a, b))
                x, y = np.searchsorted(two, (a, b))
                parts = (one[i:j] - a, doc[i:j], before[i:j], after[i:j], two[x:y] - a)
                out.append((2, buckets + int(k), number, packed(own[a:b], *(p.astype(np.uint32) for p in parts), second[x:y], pair_doc[x:y].astype(np.uint32))))
            facts = (np.array([d is None for d in doc_ids], np.uint8), np.array([d or 0 for d in doc_ids], np.int64), np.array(held, np.uint8),
                     block.sizes, n_known, base, shares)
            out.append((0, 2 * buckets + part, number, packed(*facts)))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["kind", "bucket", "block", "data"])

    def answer(_, questions, tables):
        v, m = vocab.value, backoff.value
        held = {k: unpacked(d.as_py()) for k, d in zip(tables.column("kind").to_pylist(), tables.column("data"))}
        kinds = questions.column("kind").to_pylist()
        if not kinds:
            return pa.table({"kind": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})
        own = Bucket(held, v, m) if 2 in kinds else None
        keys, counts = held.get(0, [np.zeros(0, np.uint64)] * 2)

        def pair_shares(data) -> bytes:
            asked, times, docs = data
            history, word = _apart(asked)
            n = _times(keys, counts, asked)
            out = np.log10(np.maximum(m.weight[history], 1e-300))
            out[n > 0] = m.seen(history[n > 0], n[n > 0]) - np.log10(v.base)[word[n > 0]]
            some, spot = np.unique(docs, return_inverse=True)
            more = np.bincount(spot, np.repeat(out, times), len(some))
            return packed(some.astype(np.uint32), np.zeros(len(some), np.uint32), np.zeros(len(some)), more)

        out = []
        for kind, data in zip(kinds, questions.column("data")):
            data = data.as_py()
            out.append(data if kind == 0 else pair_shares(unpacked(data)) if kind == 1 else own.answer(unpacked(data)))
        return pa.table({"kind": pa.array([int(k > 0) for k in kinds], pa.int32()), "block": questions.column("block"), "data": pa.array(out, pa.binary())})

    asked = rows.mapInArrow(ask, "kind int, bucket int, block long, data binary")
    facts = asked.groupBy("bucket").cogroup(pairs.unionByName(rare).groupBy("bucket")).applyInArrow(answer, "kind int, block long, data binary")
    tokens = vocab.value.tokens

    def together(_, rows):
        known = None
        sums = np.zeros((3, 0))
        for kind, data in sorted(zip(rows.column("kind").to_pylist(), rows.column("data")), key=lambda x: x[0]):
            values = unpacked(data.as_py())
            if kind == 0:
                known = values
                sums = np.zeros((3, len(values[0])))
            else:
                for k in range(3):
                    sums[k][values[0]] += values[k + 1]
        null, doc_id, held, n_tokens, n_known, base, shares = known
        base = base + sums[1]
        return pa.table({
            "doc_id": pa.array(doc_id, pa.int64(), mask=null.astype(bool)), "held_out": pa.array(held.astype(bool)), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known + sums[0].astype(np.int64), pa.int64()), "train_tokens": pa.array(np.full(len(null), tokens), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(base + shares + sums[2], pa.float64())})

    return facts.groupBy("block").applyInArrow(together, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _questions(kind: int, number: int, keys: np.ndarray, docs: np.ndarray, buckets: int) -> list[tuple]:
    """Distinct keys of a block, and for each the documents that hold it, by bucket."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    found = []
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(ends)):
        own = order[ends[k] : ends[k + 1]]
        distinct, times = np.unique(keys[own], return_counts=True)
        found.append((kind, int(k), number, packed(distinct, times.astype(np.uint32), docs[own].astype(np.uint32))))
    return found
