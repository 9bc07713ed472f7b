"""Language of texts and of their spans.

A model of byte triples is counted over all labelled training texts. A text's words get a score
for each language: the sum of the logarithms of its triples' shares. The script of a word's
letters narrows the languages that it may have, to those that use the script in training. A
Viterbi pass over the words of a text, where a change of language costs SWITCH, labels spans;
the text's language is the one with the most letters in its spans, and the score is that share.

Null texts and texts without letters are ``und`` with score 0; rows without a known label do not
train; with no training rows at all every text is ``und``. Equal scores go to the first language
in alphabetic order. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import fold_of, giving_back
from lakeloom.llm.tokens import slices

BINS, SWITCH, SCRIPT_SHARE = 1 << 15, 12.0, 0.01
#: First two UTF-8 bytes of letters by script: (from, to, script).
SCRIPTS = (
    (0xC380, 0xCABF, 1), (0xCDB0, 0xCFBF, 2), (0xD080, 0xD4AF, 3), (0xD4B0, 0xD68F, 4), (0xD690, 0xD7BF, 5),
    (0xD880, 0xDDBF, 6), (0xE0A4, 0xE0A5, 7), (0xE0A6, 0xE0A7, 8), (0xE0AE, 0xE0AF, 9), (0xE0B8, 0xE0B9, 10),
    (0xE182, 0xE183, 11), (0xE184, 0xE187, 12), (0xE1B8, 0xE1BB, 1), (0xE381, 0xE383, 13), (0xE390, 0xE9BF, 14), (0xEAB0, 0xED9F, 12),
)
N_SCRIPTS = 15
_SCRIPT = np.zeros(1 << 16, np.uint8)
for _a, _b, _k in SCRIPTS:
    _SCRIPT[_a : _b + 1] = _k
for _c in "abcdefghijklmnopqrstuvwxyz":
    _SCRIPT[ord(_c) << 8 : (ord(_c) + 1) << 8] = 1
_SCRIPT[0xC397] = _SCRIPT[0xC3B7] = 0  # the signs for times and divided by
_LETTER = re.compile(r"[^\W\d_]")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Words of texts laid one behind the other, each with its triples and its script."""

    def __init__(self, texts: list[str | None]):
        raw = [(" " + t.lower() + "  ").encode() if t else b"   " for t in texts]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum([0, *map(len, raw)])
        space = _SPACE[self.data]
        self.begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        self.text = np.searchsorted(starts, self.begin, "right") - 1
        pair = self.data[:-1].astype(np.uint16) << 8 | self.data[1:]
        self.letters = _SCRIPT[pair]
        if len(self.begin):
            at = np.stack([self.begin, np.minimum(self.end, len(self.letters) - 1)], 1).ravel()
            self.script = np.maximum.reduceat(self.letters, at)[::2]
            self.n_letters = np.add.reduceat((self.letters > 0).astype(np.int64), at)[::2]
        else:
            self.script, self.n_letters = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        code = self.data[:-2].astype(np.uint32) * 0x9E3779B1 ^ self.data[1:-1].astype(np.uint32) * 0x85EBCA6B ^ self.data[2:].astype(np.uint32) * 0xC2B2AE35
        #: the triple around each byte
        self.triple = (code * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 15)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Rows of a table by triple, summed over the triples around each word's bytes."""
        if not len(self.begin):
            return np.zeros((0, table.shape[1]))
        at = np.stack([self.begin - 1, self.end - 1], 1).ravel()
        out = np.empty((len(self.begin), table.shape[1]))
        for k in range(table.shape[1]):
            out[:, k] = np.add.reduceat(table[:, k][self.triple], at)[::2]
        return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word; ``scores`` holds the texts' words one behind the other.

    All texts step together, the longest first, so that those at an end drop out behind.
    """
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return labels
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    came = np.zeros(scores.shape, np.uint8)
    own = np.arange(scores.shape[1], dtype=np.uint8)
    state = scores[starts].copy()
    last = np.zeros(state.shape)
    active = len(order)
    for t in range(1, int(sizes[0]) + 1):
        now = int(np.searchsorted(-sizes, -t, "left"))  # texts with more than t words
        last[now:active] = state[now:active]
        active = now
        if not active:
            break
        state = state[:active]
        best = state.argmax(1)
        top = state[np.arange(active), best][:, None] - switch
        stay = state >= top
        rows = starts[:active] + t
        came[rows] = np.where(stay, own, best[:, None].astype(np.uint8))
        state = np.where(stay, state, top) + scores[rows]
    label = last.argmax(1)
    longest = int(sizes[0])
    for t in range(longest - 1, -1, -1):
        active = int(np.searchsorted(-sizes, -t, "left"))
        rows = starts[:active] + t
        labels[rows] = label[:active]
        label[:active] = came[rows, label[:active]]
    return labels


class Model:
    def __init__(self, counts: dict[str, np.ndarray], scripts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        table = np.zeros((BINS, max(1, len(self.langs))))
        self.allowed = np.ones((N_SCRIPTS, max(1, len(self.langs))), bool)
        for k, lang in enumerate(self.langs):
            table[:, k] = np.log((counts[lang] + 0.5) / (counts[lang].sum() + 0.5 * BINS))
            seen = scripts[lang]
            self.allowed[:, k] = seen >= SCRIPT_SHARE * max(1, seen.sum())
        self.allowed[~self.allowed.any(1)] = True
        self.table = np.ascontiguousarray(table - table.max(1, keepdims=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[str]]:
        words = Words(texts)
        scores = words.sums(self.table)
        scores[words.n_letters == 0] = 0  # signs and digits say nothing
        scores[~self.allowed[words.script] & (words.n_letters > 0)[:, None]] = -1e3
        lengths = np.bincount(words.text, minlength=len(texts))
        labels = viterbi(scores, lengths)
        weight = np.zeros((len(texts), max(1, len(self.langs))))
        np.add.at(weight, (words.text, labels), words.n_letters)
        total = weight.sum(1)
        best = weight.argmax(1)
        ends = np.cumsum(lengths)
        change = np.flatnonzero(np.diff(labels, prepend=-1) | np.diff(words.text, prepend=-1))
        langs, shares, spans = [], [], []
        at = np.searchsorted(change, ends - lengths)
        upto = np.searchsorted(change, ends)
        for k, text in enumerate(texts):
            if not self.langs or not text or not total[k] and not _LETTER.search(text):
                langs.append("und"), shares.append(0.0), spans.append("")
                continue
            if not total[k]:  # letters of a script outside the table
                langs.append(self.langs[0]), shares.append(0.0), spans.append("")
                continue
            langs.append(self.langs[best[k]])
            shares.append(float(weight[k, best[k]] / total[k]))
            cuts = [*change[at[k] : upto[k]].tolist(), int(ends[k])]
            first = int(ends[k] - lengths[k])
            spans.append(" ".join(f"{self.langs[labels[a]]}:{a - first}-{b - first}" for a, b in zip(cuts, cuts[1:])))
        return langs, shares, spans


def train(rows: DataFrame) -> Model:
    """Count triples and scripts of all rows ``text, lang``; what comes back has BINS rows a language at most."""

    def count(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in set(langs):
                words = Words([t for t, own in zip(texts, langs) if own == lang])
                inside = np.zeros(len(words.triple) + 1, np.int64)
                np.add.at(inside, words.begin - 1, 1)
                np.add.at(inside, words.end - 1, -1)
                used = words.triple[np.cumsum(inside)[:-1] > 0]
                grams[lang] = grams.get(lang, 0) + np.bincount(used, minlength=BINS)
                scripts[lang] = scripts.get(lang, 0) + np.bincount(words.script[words.n_letters > 0], minlength=N_SCRIPTS)
        for lang in grams:
            both = np.concatenate([grams[lang], scripts[lang]])
            seen = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(both[seen], pa.int64())], names=["lang", "slot", "n"])

    found = rows.select("text", "lang").mapInArrow(giving_back(count), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    sums = {}
    for lang, own in found.groupby("lang"):
        sums[lang] = np.zeros(BINS + N_SCRIPTS, np.int64)
        sums[lang][own["slot"].to_numpy()] = own["n"].to_numpy()
    return Model({k: v[:BINS] for k, v in sums.items()}, {k: v[BINS:] for k, v in sums.items()})


def labelled(rows: DataFrame, model: Model, *keep: Column | str) -> DataFrame:
    """The rows' kept columns and ``lang_pred``, ``score``, ``spans`` (words from-to by language)."""
    picked = rows.select(*keep, F.col("text").alias("__text"))
    names = picked.columns[:-1]
    schema = picked.select(*names).schema.add("lang_pred", "string").add("score", "double").add("spans", "string")

    def rows_(batches):
        for batch in (part for whole in batches for part in slices(whole, "__text")):
            found = model.predict(batch.column("__text").to_pylist())
            columns = [batch.column(c) for c in names]
            columns += [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score", "spans"])

    return picked.mapInArrow(giving_back(rows_), schema)


def predict_all(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Train on the folds but the first, predict all."""
    held = fold_of("doc_id", folds) == 0
    model = train(docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return labelled(docs, model, "doc_id", held.alias("held_out"))
