"""Encoding of whole texts with a tokenizer file of the ``tokenizers`` library.

The library reads about one megabyte a second, and texts repeat their words. So a batch
of texts is cut into pieces where a cut cannot change any id, the distinct pieces are
found with array operations, and the library's model is asked only about pieces that the
worker has not met. Safe cuts, by the split patterns of byte-level and of word tokenizers:

* before a single space and around a single line feed, other characters on both sides;
* between an ASCII letter and one of ``. , ! ? ; :``.

White space of any other form stays inside a piece, which then goes to the library whole,
as do texts with white space beyond ASCII.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers; the memory is emptied when it is full.
CACHED_PIECES = 600_000
#: Bytes of text that are cut up at once.
CHUNK_BYTES = 1 << 20
_RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,!?;:"]] = True
#: Two odd multipliers; pieces are told apart by both hashes.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@functools.cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse, modulo 2**64."""
    out = []
    for step in (base, pow(base, -1, 1 << 64)):
        powers = np.full(CHUNK_BYTES + 1, step, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for base in _BASES:
        powers, inverse = _powers(base)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts]
        h ^= h >> np.uint64(31)
        found.append(h * np.uint64(0xBF58476D1CE4E5B9) ^ (ends - starts).astype(np.uint64))
    return found[0], found[1]


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts that lie one behind the other in ``data``."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    space = _SPACE[data]
    before = np.ones(n, bool)  # white space, or the text's start, comes before
    before[1:] = space[:-1]
    before |= edge[:-1]
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    after |= edge[1:]
    single = space & ~before & ~after
    cut = edge[:-1].copy()
    cut |= single & ((data == 32) | (data == 10))
    line = single & (data == 10)
    cut[1:] |= line[:-1]
    stop = _STOP[data] & ~edge[:-1]
    stop[1:] &= _LETTER[data[:-1]]
    cut |= stop
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of texts. ``lowers``: the tokenizer lower-cases and drops white space."""

    def __init__(self, path: str, lowers: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their names in a text are ordinary text
        self.model = self.library.model
        self.lowers = lowers
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {
            ord(c): level.pre_tokenize_str(c)[0][0] for c in " " + "".join(map(chr, range(0xC0, 0x100)))
        }
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _ask(self, piece: str) -> list[int]:
        if _WORD.fullmatch(piece):
            if self.lowers:
                piece = piece.lstrip(" ").lower()
            return [t.id for t in self.model.tokenize(piece.translate(self.spelling))]
        return self.library.encode(piece, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        found = [self._ask(p) for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        if self.used + total > len(self.ids):
            grown = np.zeros(2 * (self.used + total), np.uint32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        slots = len(self.lengths) + np.arange(len(found))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.used += total
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.checks = np.insert(self.checks, at, checks)
        self.slots = np.insert(self.slots, at, slots)

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and counts by text; None if two pieces share a hash."""
        starts = cut_pieces(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, checks = _hashes(data, starts, ends)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if not np.array_equal(checks[first][inverse], checks):
            return None
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not np.array_equal(self.checks[at[known]], checks[first[known]]):
            return None
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self._learn(distinct[~known], checks[new], pieces)
            at = np.searchsorted(self.keys, distinct)
        slot = self.slots[at][inverse]
        sizes = self.lengths[slot]
        total = int(sizes.sum())
        shift = np.repeat(self.starts[slot] - (np.cumsum(sizes) - sizes), sizes)
        ids = self.ids[shift + np.arange(total)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        piece_of_text = np.searchsorted(starts, offsets)
        return ids, np.diff(before[piece_of_text])

    def _whole(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch(list(texts), add_special_tokens=False)]
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, sum(map(len, found)))
        return flat, np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: Sequence[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of texts as arrays to be read one behind the other, and the count of each text (null: none)."""
        parts, counts = [], []
        group: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal group, size
            if not group:
                return
            if len(self.keys) > CACHED_PIECES:
                self._forget()
            offsets = np.cumsum([0, *map(len, group)])
            done = self._chunk(np.frombuffer(b"".join(group), np.uint8), offsets) if size else None
            ids, count = done or self._whole([t.decode() for t in group])
            parts.append(ids)
            counts.append(count)
            group, size = [], 0

        for text in texts:
            text = text or ""
            data = text.encode()
            if len(data) > CHUNK_BYTES or not text.isascii() and _RARE_SPACE.search(text):
                flush()
                ids, count = self._whole([text])
                parts.append(ids)
                counts.append(count)
                continue
            if size + len(data) > CHUNK_BYTES:
                flush()
            group.append(data)
            size += len(data)
        flush()
        return parts, np.concatenate(counts) if counts else np.zeros(0, np.int64)


@functools.lru_cache(maxsize=4)
def encoder(path: str, lowers: bool) -> PieceEncoder:
    """One encoder for each worker process."""
    return PieceEncoder(path, lowers)


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20):
    """Parts of a batch with about ``size`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // size
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def encoded_batches(batches, path: str, lowers: bool, end: int):
    """For each Arrow batch with a column ``text``: the batch and the ids of each row, its end id included."""
    own = encoder(path, lowers)
    for batch in (part for whole in batches for part in slices(whole, "text")):
        parts, counts = own.encode(batch.column("text").to_pylist())
        ids = np.concatenate(parts)
        places = np.cumsum(counts)
        yield batch, np.insert(ids, places, np.uint32(end)), counts + 1


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """One Arrow batch from arrays, cast to the schema's types."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)],
        schema=schema,
    )
