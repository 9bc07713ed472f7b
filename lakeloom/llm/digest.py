"""Fingerprints of improbable features in chained Bloom filters.

Every byte window of a text has a Shannon entropy; how often each entropy occurs is counted over
the whole corpus, and rare ones rank first (windows of very low entropy rank last). In every run
of RUN windows the leftmost of the first rank wins; windows that win at least WINS runs are the
text's features. They enter Bloom filters of FILTER_BITS bits, a new filter after FILTER_FEATURES
features. Two fingerprints are as alike as each filter of the one with fewer filters is to its
best partner: common bits beyond those expected by chance, over the most that are possible.

Texts below SHORT bytes are described by all their short windows instead, and a null or empty text has none (equal fingerprints: likeness 1, else 0). Rows with a
null doc_id come last, rows with equal doc_id follow each other by text; an only row is its own
neighbour. Other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import parts_for

WINDOW, RUN, WINS, BINS, WEAK = 32, 32, 8, 1000, 200
#: Texts below SHORT bytes are described by all their windows of SHORT_WINDOW bytes.
SHORT, SHORT_WINDOW = 96, 8
FILTER_BITS, FILTER_FEATURES, BITS_A_FEATURE, CUT = 2048, 128, 5, 0.1
CHUNK, ROWS_PER_PART = 1 << 18, 2048
_LAST = -(1 << 63)
#: c log c in fixed point, for counts within a window.
_PART = np.array([0] + [round(c * np.log2(c) * 1024) for c in range(1, WINDOW + 1)], np.int32)
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_features", pa.int64())])


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Entropy of each window of WINDOW bytes, in thousandths of the largest.

    Equal bytes at each distance are counted for all positions at once; these counts say how the
    sum of c log c changes when the window moves by a byte.
    """
    n = len(data)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for gap in range(1, WINDOW):
        same = data[gap:] == data[:-gap]
        before[gap:] += same
        after[:-gap] += same
    step = np.diff(_PART)  # what one more byte adds to a count of c
    change = np.zeros(n - WINDOW + 1, np.int64)
    change[0] = _PART[np.bincount(data[:WINDOW])].sum()
    change[1:] = step[before[WINDOW:]].astype(np.int64) - step[after[: n - WINDOW]]
    total = np.cumsum(change)
    most = int(_PART[WINDOW])
    return ((most - total) * BINS // most).astype(np.int32)


def _chunks(texts: list[bytes]):
    """Texts laid one behind the other: (text index, first window, bytes) pieces of about CHUNK bytes.

    A long text comes in pieces that overlap by what the windows at the seams need.
    """
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < SHORT:
            continue
        for a in range(0, len(text) - WINDOW + 1, CHUNK):
            held.append((k, a, text[max(0, a - RUN + 1) : a + CHUNK + RUN + WINDOW - 2]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def bin_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(BINS + 1, np.int64)
    for held in _chunks(texts):
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        bins, at = entropy_bins(data), 0
        for _, a, piece in held:
            skip = min(a, RUN - 1)
            own = bins[at + skip : min(at + skip + CHUNK, at + len(piece) - WINDOW + 1)]
            counts += np.bincount(own, minlength=BINS + 1)
            at += len(piece)
    return counts


def rank_bins(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the rarest first and the low ones last."""
    order = sorted(range(BINS + 1), key=lambda b: (b < WEAK, int(counts[b]) if b >= WEAK else -b, b))
    ranks = np.empty(BINS + 1, np.int64)
    ranks[order] = np.arange(BINS + 1)
    return ranks


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if width > step else values


def _hash_windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at].view("<u8")
    h = np.full(len(at), 0x243F6A8885A308D3, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def features(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Hashes of each text's features in their order, each once."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    least: dict[int, tuple[int, np.ndarray]] = {}  # of texts without such a window so far, the best one and its rank
    for k, text in enumerate(texts):
        if 0 < len(text) < SHORT:
            padded = b"".join(text[a : a + SHORT_WINDOW].ljust(WINDOW, b"\0") for a in range(max(1, len(text) - SHORT_WINDOW + 1)))
            found[k].append(_hash_windows(np.frombuffer(padded, np.uint8), np.arange(0, len(padded), WINDOW)))
    for held in _chunks(texts):
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        keys = ranks[entropy_bins(data)] << 32 | np.arange(len(data) - WINDOW + 1)
        lows = _sliding_min(keys, RUN) & 0xFFFFFFFF if len(keys) >= RUN else keys[:0]
        wins = np.zeros(len(data), np.int64)
        at = 0
        spans = []
        for k, a, piece in held:
            windows = len(piece) - WINDOW + 1
            if windows < RUN:
                wins[(keys[at : at + windows].min()) & 0xFFFFFFFF] = WINS
            else:
                wins[at : at + windows] += np.bincount(lows[at : at + windows - RUN + 1] - at, minlength=windows)
            skip = min(a, RUN - 1)
            spans.append((k, at + skip, min(at + skip + CHUNK, at + windows)))
            at += len(piece)
        chosen = np.flatnonzero(wins >= WINS)
        hashed = _hash_windows(data, chosen)
        for k, a, b in spans:
            i, j = np.searchsorted(chosen, (a, b))
            if j > i:
                found[k].append(hashed[i:j])
            elif b > a and not found[k]:
                best = int(keys[a:b].min())
                if k not in least or best >> 32 < least[k][0]:
                    least[k] = best >> 32, _hash_windows(data, np.array([best & 0xFFFFFFFF]))
    for k, (_, own) in least.items():
        if not found[k]:  # no window wins often, in no chunk: the best one of all stands for the text
            found[k].append(own)
    out = []
    for parts in found:
        if not parts:
            out.append(np.zeros(0, np.uint64))
            continue
        flat = np.concatenate(parts)
        _, first = np.unique(flat, return_index=True)
        out.append(flat[np.sort(first)])
    return out


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters as rows of bytes."""
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), bool)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(BITS_A_FEATURE):
        bits[row, (hashes >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BITS - 1)] = True
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: mean over the filters of the shorter chain of the best normalised overlap in the other."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    ones_a, ones_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    if (len(a), ones_a.sum()) > (len(b), ones_b.sum()):
        a, b, ones_a, ones_b = b, a, ones_b, ones_a
    total = 0.0
    for row, ones in zip(a, ones_a):
        common = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        least = np.minimum(ones, ones_b)
        chance = ones * ones_b / FILTER_BITS
        floor = chance + CUT * (least - chance)
        total += max(0.0, float(np.max((common - floor) / np.maximum(least - floor, 1e-9)))) * float(ones)
    return min(1.0, total / float(ones_a.sum()))


def fingerprint(count: int, rows: np.ndarray) -> str:
    return f"{count}:{base64.b64encode(rows.tobytes()).decode()}"


def entropy_ranks(docs: DataFrame) -> np.ndarray:
    """Ranks from the entropies of all windows of all texts; each task sends one row per entropy at most."""

    def count(batches):
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            total += bin_counts([t.encode() for t in batch.column("text").to_pylist() if t])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bin", "n"])

    rows = docs.select("text").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # BINS + 1 rows at most
    counts = np.zeros(BINS + 1, np.int64)
    for r in rows:
        counts[r.bin] = r.n
    return rank_bins(counts)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Rows ``bucket, extra, place, doc_id, text`` such that a bucket holds consecutive documents in descending
    order and, marked ``extra``, the first one of the bucket behind it (the last bucket: the very first)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("place"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = parts_for(rows, ROWS_PER_PART)
    bounds = sorted(set(rows.select("place").where(F.col("place") != _LAST).approxQuantile("place", [k / n for k in range(1, n)], 0.2 / n)))
    # binary search: how many bounds are at most the place; buckets count down from the largest
    search = (
        f"aggregate(sequence(1, {max(1, len(bounds).bit_length() + 1)}), named_struct('lo', 0, 'hi', {len(bounds)}), (s, k) -> "
        "CASE WHEN s.lo >= s.hi THEN s WHEN bounds[(s.lo + s.hi) div 2] <= place THEN named_struct('lo', cast((s.lo + s.hi) div 2 + 1 as int), 'hi', s.hi) "
        f"ELSE named_struct('lo', s.lo, 'hi', cast((s.lo + s.hi) div 2 as int)) END, s -> {len(bounds)} - s.lo)"
    )
    listed = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.lit([]).cast("array<double>")
    placed = rows.withColumn("bounds", listed).withColumn("bucket", F.expr(search)).drop("bounds")
    heads = sorted((r.bucket, r.place) for r in placed.groupBy("bucket").agg(F.max("place").alias("place")).collect())  # a row per bucket
    before = [(place, heads[k - 1][0]) for k, (_, place) in enumerate(heads)]
    copies = spark.createDataFrame(before, "place long, before int").groupBy("place").agg(F.collect_list("before").alias("before"))
    both = placed.join(F.broadcast(copies), "place", "left").select(
        F.explode(F.expr(
            "concat(array(named_struct('bucket', bucket, 'extra', false)), "
            "transform(coalesce(before, cast(array() as array<int>)), b -> named_struct('bucket', b, 'extra', true)))")).alias("to"),
        "place", "doc_id", "text")
    ranged = both.select("to.bucket", "to.extra", "place", "doc_id", "text").repartitionByRange(n, "bucket")
    return ranged.sortWithinPartitions("bucket", "extra", F.desc("place"), "text")


def digests(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited forms, and their likeness to those and to the next text."""
    ranks = entropy_ranks(docs)

    def rows(batches):
        held: list[tuple] = []  # consecutive rows of one bucket; the last one waits for its neighbour
        size, done = 0, False

        def flush():
            nonlocal held, size
            texts = [t or "" for _, t in held]
            edited = []
            for text, after in zip(texts, texts[1:]):
                k = len(text) // 3
                edited.append(text[: len(text) - k] + after[:k])
            raw = [t.encode() for t in edited]
            hashes = features([t.encode() for t in texts] + raw, ranks)
            made = [filters(h) for h in hashes]
            spelled = [fingerprint(len(h), m) for h, m in zip(hashes, made)]
            n = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((
                [d for d, _ in held[:-1]], [len(t) for t in texts[:-1]], [hashlib.sha256(r).hexdigest() for r in raw],
                spelled[: n - 1], spelled[n:], [likeness(a, b) for a, b in zip(made, made[n:])],
                [likeness(a, b) for a, b in zip(made[: n - 1], made[1:n])], [len(h) for h in hashes[: n - 1]]), _OUT)], schema=_OUT)
            held, size = held[-1:], 0

        bucket = None
        for batch in batches:
            for own, extra, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "text"))):
                if own != bucket:
                    held, size, done, bucket = [], 0, False, own
                if done:
                    continue
                held.append((doc_id, text))
                size += len(text or "")
                if extra:
                    yield from flush()
                    done = True
                elif size > 1 << 21 and len(held) > 1:
                    yield from flush()

    kinds = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, n_features long")
    return with_neighbours(docs).mapInArrow(rows, kinds)
