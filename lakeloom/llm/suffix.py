"""Removal of byte strings that start in an earlier document, by suffix sorting.

Every string of LENGTH bytes has an anchor: the leftmost smallest hash among its GRAM-byte grams.
Equal strings have equal anchors, so all their places meet in one group of an anchor's hash. What
a group compares are contexts: the bytes of all the strings of a place that share the anchor.

1. Blocks of documents are written once, bucketed by block, so that later steps read them in place.
2. Blocks ask which anchors occur in two documents or more; hashes are exchanged as sorted arrays.
3. Blocks send the contexts of shared anchors, equal ones once with their smallest doc_id. Anchors
   whose contexts are all alike are settled at once. The others are suffix-sorted by the linear
   grouping construction, and neighbours with a long enough common prefix share their owner.
4. Blocks learn the owner of each of their strings and cut what a smaller doc_id owns.

A frequent passage reaches a group once per block and context, not once per document.

Strings are compared as they stand in the input; matches never cross documents; null and empty texts have no
bytes; documents with the same doc_id do not cut each other; a null doc_id counts as larger than
all others. Other columns are kept out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import note, staged
from lakeloom.llm.packed import packed, unpacked
from lakeloom.session import scratch_dir

LENGTH, GRAM = 50, 20
REACH = LENGTH - GRAM  # a string starts this many bytes before its anchor at most
BLOCK_BYTES, PART_BYTES, ROWS_PER_BUCKET = 4 << 20, 1 << 19, 1 << 19
_LAST = (1 << 63) - 1


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffixes in order, by grouping; the last symbol must be the only smallest one.

    Suffixes are grouped by the Lyndon prefix known so far. Groups are taken from the largest down:
    every member finds the nearest suffix before it in a smaller group, and those that were found
    move up behind their group, the oftener the further, as their prefixes have grown. Then the
    order inside the groups follows from the order of the suffixes that come behind the prefixes.
    """
    n = len(symbols)
    layout = sorted(range(n), key=symbols.__getitem__)
    place, start, size = [0] * n, [0] * n, [0] * n
    head = 0
    for k, i in enumerate(layout):
        if symbols[i] != symbols[layout[head]]:
            head = k
        place[i], start[i] = k, head
        size[head] += 1
    before = [-1] * n
    top = n
    while top:
        low = start[layout[top - 1]]
        found: dict[int, int] = {}
        members = layout[low:top]
        members.sort()
        for i in members:
            p = i - 1
            while p >= 0 and start[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        top = low
        if not found:
            continue
        moved: dict[tuple[int, int], list[int]] = {}
        for p, c in found.items():
            moved.setdefault((-c, start[p]), []).append(p)
        for _, old in sorted(moved) if len(moved) > 1 else moved:
            own = moved[_, old]
            end = old + size[old]
            for p in own:
                end -= 1
                other, at = layout[end], place[p]
                layout[at], place[other] = other, at
                layout[end], place[p] = p, end
            if end > old:
                size[old] -= len(own)
                size[end] = len(own)
                for p in own:
                    start[p] = end
    order, filled, put = [n - 1] * n, [0] * n, [False] * n
    put[n - 1] = True
    for k in range(n):
        p = order[k] - 1
        while p >= 0 and not put[p]:
            head = start[p]
            order[head + filled[head]] = p
            filled[head] += 1
            put[p] = True
            p = before[p]
    return order


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix with the one before it in the order."""
    n = len(symbols)
    rank, out, k = [0] * n, [0] * n, 0
    for r, i in enumerate(order):
        rank[i] = r
    for i in range(n):
        r = rank[i]
        if not r:
            k = 0
            continue
        j = order[r - 1]
        while symbols[i + k] == symbols[j + k]:
            k += 1
        out[r] = k
        if k:
            k -= 1
    return out


def _most_common(parts: list[bytes]) -> list[int]:
    """How long a prefix each part shares with any other one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        a, b = parts[i], parts[j]
        n = min(len(a), len(b))
        if a[:n] != b[:n]:
            n = next(k for k in range(n) if a[k] != b[k])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def owners(contexts: list[bytes], lefts: list[int], docs: list[int]) -> list[list[int]]:
    """For each context the smallest document of each of its strings, from the left.

    ``lefts`` says where the anchor starts. As every string holds the whole anchor, it counts as one
    symbol; what a context shares with no other one on either side cannot be in a common string and
    is left out of the sorting.
    """
    whole = [[doc] * (len(c) - LENGTH + 1) for c, doc in zip(contexts, docs)]
    near_left = _most_common([c[:left][::-1] for c, left in zip(contexts, lefts)])
    near_right = _most_common([c[left + GRAM :] for c, left in zip(contexts, lefts)])
    cut: dict[tuple[bytes, bytes], list[int]] = {}
    for i, (c, left) in enumerate(zip(contexts, lefts)):
        if near_left[i] + near_right[i] >= REACH:
            cut.setdefault((c[left - near_left[i] : left], c[left + GRAM : left + GRAM + near_right[i]]), []).append(i)
    symbols: list[int] = []
    owner, firsts = [], []
    for (left, right), own in cut.items():
        firsts.append(len(symbols))
        part = [b + 3 for b in left] + [2] + [b + 3 for b in right] + [1]
        symbols += part
        owner += [min(docs[i] for i in own)] * len(part)
    if len(cut) > 1:
        symbols.append(0)
        owner.append(_LAST)
        order = suffix_array(symbols)
        same = common_prefixes(symbols, order)
        run = [0]
        for k in range(1, len(order) + 1):
            if k == len(order) or same[k] <= REACH:
                if len(run) > 1:
                    best = min(owner[i] for i in run)
                    for i in run:
                        owner[i] = best
                run = []
            if k < len(order):
                run.append(order[k])
    for first, ((left, right), own) in zip(firsts, cut.items()):
        for i in own:
            at = lefts[i] - len(left)
            n = min(len(left) + len(right) - REACH + 1, len(whole[i]) - at)
            whole[i][at : at + n] = owner[first : first + n]
    return whole


class Anchors:
    """Anchors of documents laid one behind the other: place, hash, first and last string start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        room = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
        parts = [self._part(data, offsets[:-1], room, a) for a in range(0, max(0, len(data) - LENGTH + 1), PART_BYTES)]
        self.at, self.first, self.last = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in range(3))
        self.hash = np.concatenate([np.zeros(0, np.uint64), *(p[3] for p in parts)])

    @staticmethod
    def _part(data: np.ndarray, starts: np.ndarray, room: np.ndarray, a: int):
        """Anchors of the strings that start in one part; a part's border may split an anchor's strings into two rows."""
        b = min(a + PART_BYTES, len(data) - LENGTH + 1)
        inside = np.zeros(b - a + 1, np.int64)
        low, high = np.clip(starts, a, b), np.clip(starts + room, a, b)
        np.add.at(inside, low - a, 1)
        np.add.at(inside, high - a, -1)
        valid = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        h = gram_hashes(data[a : b + LENGTH - 1])
        best = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step * 2 <= REACH + 1:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        rest = REACH + 1 - step
        best = np.minimum(best[: len(best) - rest], best[rest:]) if rest else best
        at = (best[valid] & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=-1))
        last = valid[np.append(new[1:], len(at)) - 1] if len(at) else valid
        return at[new] + a, valid[new] + a, last + a, h[at[new]]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling."""
    mul = np.uint64(0x9E3779B97F4A7C15)

    def mixed(a, b):
        h = (a ^ (a >> np.uint64(29))) * mul + b
        return h ^ (h >> np.uint64(32))

    one = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    two = mixed(one[:-1], one[1:])
    four = mixed(two[:-2], two[2:])
    eight = mixed(four[:-4], four[4:])
    sixteen = mixed(eight[:-8], eight[8:])
    return mixed(sixteen[: len(data) - GRAM + 1], four[16 : 16 + len(data) - GRAM + 1]) * mul


def _texts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, offsets, text = unpacked(data)
    return ids, offsets, text


def _split(keys: np.ndarray, buckets: int):
    """Bucket of each hash, and for each used bucket the places of its keys."""
    bucket = (keys >> np.uint64(33)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(ends)):
        yield int(k), order[ends[k] : ends[k + 1]]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), kinds)], names=["bucket", "block", "data"])


_ROWS = "bucket int, block long, data binary"


class Sorted:
    """The steps for one set of documents; ``key`` is the column that orders them."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.buckets = max(4, -(-int(letters) // 16 // ROWS_PER_BUCKET))  # about an anchor in 16 bytes
        width = max(4, -(-int(letters) // (6 * BLOCK_BYTES)))

        def blocks(batches):
            from pyspark import TaskContext

            held, size, nth = [], 0, TaskContext.get().partitionId() << 24

            def out():
                nonlocal held, size, nth
                ids = np.array([_LAST if d is None else d for d, _ in held], np.int64)
                offsets = np.cumsum([0, *(len(t) for _, t in held)]).astype(np.int64)
                made = packed(ids, offsets, np.frombuffer(b"".join(t for _, t in held), np.uint8))
                null = bytes(d is None for d, _ in held)
                row = pa.RecordBatch.from_arrays([pa.array([nth], pa.int64()), pa.array([made]), pa.array([null])], names=["block", "data", "nulls"])
                held, size, nth = [], 0, nth + 1
                return row

            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    text = (text or "").encode()
                    if held and size + len(text) > 2 * BLOCK_BYTES:
                        yield out()
                    held.append((doc_id, text))
                    size += len(text)
                    if size >= BLOCK_BYTES:
                        yield out()
            if held:
                yield out()

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(blocks, "block long, data binary, nulls binary")
        name = f"blocks_{uuid.uuid4().hex}"
        path = scratch_dir(self.spark, "blocks")
        note(path, name)
        rows.write.bucketBy(width, "block").sortBy("block").format("parquet").option("path", path).saveAsTable(name)
        self.blocks = self.spark.table(name)

    def _with(self, answers: DataFrame, run, kinds: str) -> DataFrame:
        return self.blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, kinds)

    def cuts(self) -> DataFrame:
        """``block, data``: for each block the strings that a smaller doc_id owns, as starts in the block."""
        buckets = self.buckets

        def ask(batches):
            for batch in batches:
                for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                    _, offsets, text = _texts(data.as_py())
                    found = Anchors(text, offsets)
                    doc = np.searchsorted(offsets, found.at, "right") - 1
                    keys, many = _documents(found.hash, doc)
                    yield _rows([(k, block, packed(keys[own], many[own].astype(np.uint8))) for k, own in _split(keys, buckets)])

        def shared(_, rows):
            held = [unpacked(d.as_py()) for d in rows.column("data")]
            keys = np.concatenate([h[0] for h in held])
            distinct, spot = np.unique(keys, return_inverse=True)
            often = np.bincount(spot, np.concatenate([h[1] for h in held]).astype(np.int64) + 1) >= 2
            out = [(k, b, packed(np.packbits(often[np.searchsorted(distinct, h[0])]))) for k, b, h in zip(rows.column("bucket").to_pylist(), rows.column("block").to_pylist(), held)]
            return pa.Table.from_batches([_rows(out)])

        asked = self.blocks.select("block", "data").mapInArrow(ask, _ROWS)
        first = staged(asked.groupBy("bucket").applyInArrow(shared, _ROWS), "shared")

        def contexts(_, rows, answers):
            if not rows.num_rows or not answers.num_rows:
                return pa.Table.from_batches([_rows([])])
            block, (ids, offsets, text) = rows.column("block")[0].as_py(), _texts(rows.column("data")[0].as_py())
            found = Anchors(text, offsets)
            some = _shared_anchors(found, offsets, buckets, answers)
            kept, _, best = _distinct_contexts(found, some, text, offsets, ids)
            out = []
            lengths = found.last[kept] + LENGTH - found.first[kept]
            for k, own in _split(found.hash[kept], buckets):
                spots = np.repeat(found.first[kept][own], lengths[own]) + _steps(lengths[own])
                out.append((k, block, packed(found.hash[kept][own], (found.at - found.first)[kept][own].astype(np.uint8), lengths[own].astype(np.uint8), best[own], text[spots])))
            return pa.Table.from_batches([_rows(out)])

        sent = self._with(first, contexts, _ROWS)
        second = staged(sent.groupBy("bucket").applyInArrow(_owned, _ROWS), "owners")

        def cut(_, rows, answers):
            empty = pa.table({"block": pa.array([], pa.int64()), "data": pa.array([], pa.binary()), "nulls": pa.array([], pa.binary()), "starts": pa.array([], pa.binary())})
            if not rows.num_rows:
                return empty
            block, data = rows.column("block")[0].as_py(), rows.column("data")[0].as_py()
            ids, offsets, text = _texts(data)
            starts = np.zeros(0, np.int64)
            asked_ = [(k, d) for k, d, kind in zip(answers.column("bucket").to_pylist(), answers.column("data"), answers.column("kind").to_pylist()) if kind == 1]
            told = [(k, d) for k, d, kind in zip(answers.column("bucket").to_pylist(), answers.column("data"), answers.column("kind").to_pylist()) if kind == 2]
            if told:
                found = Anchors(text, offsets)
                some = _shared_bits(found, offsets, buckets, asked_)
                kept, member, _ = _distinct_contexts(found, some, text, offsets, ids)
                lengths = found.last[kept] - found.first[kept] + 1
                begins = np.cumsum(lengths) - lengths
                owner = np.full(int(lengths.sum()), _LAST, np.int64)
                replies = dict(told)
                for k, own in _split(found.hash[kept], buckets):
                    spots = np.repeat(begins[own], lengths[own]) + _steps(lengths[own])
                    owner[spots] = unpacked(replies[k].as_py())[0]
                own = lengths[member]
                strings = np.repeat(found.first[some], own) + _steps(own)
                whose = owner[np.repeat(begins[member], own) + _steps(own)]
                doc = np.searchsorted(offsets, strings, "right") - 1
                starts = strings[whose < ids[doc]]
            return pa.table({"block": pa.array([block], pa.int64()), "data": pa.array([data], pa.binary()), "nulls": rows.column("nulls"), "starts": pa.array([packed(np.sort(starts).astype(np.uint64))], pa.binary())})

        both = first.withColumn("kind", F.lit(1)).unionByName(second.withColumn("kind", F.lit(2)))
        return self._with(both, cut, "block long, data binary, nulls binary, starts binary")


def _steps(lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _documents(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and whether more than one document of the block has them."""
    if not len(hashes):
        return hashes, np.zeros(0, bool)
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    ends = np.append(first[1:], len(hashes)) - 1
    return hashes[first], doc[ends] != doc[first]


def _shared_anchors(found: Anchors, offsets: np.ndarray, buckets: int, answers) -> np.ndarray:
    return _shared_bits(found, offsets, buckets, list(zip(answers.column("bucket").to_pylist(), answers.column("data"))))


def _shared_bits(found: Anchors, offsets: np.ndarray, buckets: int, answers: list) -> np.ndarray:
    """Places of the anchors that two documents or more have."""
    doc = np.searchsorted(offsets, found.at, "right") - 1
    keys, _ = _documents(found.hash, doc)
    often = np.zeros(len(keys), bool)
    replies = dict(answers)
    for k, own in _split(keys, buckets):
        often[own] = np.unpackbits(unpacked(replies[k].as_py())[0])[: len(own)]
    return np.flatnonzero(often[np.searchsorted(keys, found.hash)])


def _distinct_contexts(found: Anchors, some: np.ndarray, text: np.ndarray, offsets: np.ndarray, ids: np.ndarray):
    """One anchor for each context in order of hashes, which of them each shared anchor has, and its smallest doc_id in the block."""
    lengths = found.last[some] + LENGTH - found.first[some]
    wide = LENGTH + REACH
    mark = np.full(len(some), 0x243F6A8885A308D3, np.uint64) ^ (lengths * 256 + (found.at - found.first)[some]).astype(np.uint64)
    padded = np.concatenate([text, np.zeros(wide + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for k in range(0, wide, 8):
        part = np.ascontiguousarray(words[found.first[some] + k]).view("<u8").ravel()
        over = np.clip(8 - (lengths - k), 0, 8)
        part = np.where(over == 8, 0, part & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (over % 8 * 8).astype(np.uint64)))
        mark = (mark ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mark ^= mark >> np.uint64(31)
    doc = ids[np.searchsorted(offsets, found.at[some], "right") - 1]
    order = np.lexsort((doc, mark, found.hash[some]))
    h, m = found.hash[some][order], mark[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (m[1:] != m[:-1])]) if len(order) else np.zeros(0, bool)
    member = np.empty(len(order), np.int64)
    member[order] = np.cumsum(new) - 1
    lead = order[np.flatnonzero(new)]
    return some[lead], member, doc[lead]


def _owned(_, rows):
    """Owners of all strings of the contexts that meet in a bucket, for each block as it asked."""
    held = [unpacked(d.as_py()) for d in rows.column("data")]
    hashes = np.concatenate([h[0] for h in held])
    lefts, lengths = (np.concatenate([h[k] for h in held]).astype(np.int64) for k in (1, 2))
    docs = np.concatenate([h[3] for h in held])
    text = np.concatenate([h[4] for h in held]).tobytes()
    ends = np.cumsum(lengths)
    strings = lengths - LENGTH + 1
    places = np.cumsum(strings) - strings
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    owner = np.repeat(docs, strings)
    for a, b in zip(first.tolist(), np.append(first[1:], len(order)).tolist()):
        if b - a < 2:
            continue
        group: dict[tuple[bytes, int], list[int]] = {}
        for i in order[a:b].tolist():
            group.setdefault((text[ends[i] - lengths[i] : ends[i]], int(lefts[i])), []).append(i)
        smallest = [int(docs[own].min()) for own in group.values()]
        found = [[d] for d in smallest] if len(group) == 1 else owners([c for c, _ in group], [x for _, x in group], smallest)
        for own, values in zip(group.values(), found):
            for i in own:
                owner[places[i] : places[i] + strings[i]] = values
    out, at = [], 0
    for k, block, h in zip(rows.column("bucket").to_pylist(), rows.column("block").to_pylist(), held):
        n = int((h[2].astype(np.int64) - LENGTH + 1).sum())
        out.append((k, block, packed(owner[at : at + n])))
        at += n
    return pa.Table.from_batches([_rows(out)])


def kept_parts(data: bytes, starts: bytes):
    """For each document of a block: its id, its bytes, and which of them stay."""
    ids, offsets, text = _texts(data)
    where = unpacked(starts)[0].astype(np.int64)
    gone = np.zeros(len(text) + 1, np.int64)
    np.add.at(gone, where, 1)
    np.add.at(gone, where + LENGTH, -1)
    stays = np.cumsum(gone[:-1]) == 0
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        yield k, int(ids[k]), text[a:b], stays[a:b]


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removed(docs: DataFrame) -> DataFrame:
    """Every document's size, what is removed, and the digest of what stays."""

    def rows(batches):
        for batch in batches:
            for data, nulls, starts in zip(batch.column("data"), batch.column("nulls"), batch.column("starts")):
                null = nulls.as_py()
                out = []
                for k, doc_id, text, stays in kept_parts(data.as_py(), starts.as_py()):
                    spans = int(np.count_nonzero(~stays[1:] & stays[:-1])) + int(len(stays) > 0 and not stays[0])
                    out.append((None if null[k] else doc_id, len(text), int(np.count_nonzero(~stays)), spans, hashlib.sha256(text[stays].tobytes()).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DIGEST)], schema=_DIGEST)

    return Sorted(docs).cuts().mapInArrow(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
