"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again as
the documents of the next one. The first four return the columns of ``documents``; the last one
returns a row for each token piece with its sequence and place. As the result of a stage is written
before the next one starts, every stage first deletes what the one before it kept in the shared folder.

Null texts count as empty; language identification rejects them. Rows with null or repeated doc_ids go
through all stages, and columns of any name do.
"""

from __future__ import annotations

import functools

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.llm import decontam, langid, overlap, packing, suffix
from lakeloom.llm.common import discard, read_table, recorded, small_batches
from lakeloom.llm.token_file import tokenizer_path
from lakeloom.session import in_utc, scratch_dir

#: Share of a document's letters that must be in its one language.
SURE_LANGUAGE = 0.5
#: Near-duplicates: words in a shingle, and the least Jaccard similarity in percent.
SHINGLE, LIKE = 5, 80
#: What the last stage has staged.
_LEFT: list[tuple[str, str | None]] = []


def tidy(stage):
    """Delete what the stage before has staged, note what this one stages."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _LEFT)
        _LEFT.clear()
        with recorded() as made:
            try:
                return stage(small_batches(spark), docs, sf_dir)
            finally:
                _LEFT.extend(made)

    return run


@tidy
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that have letters and a main language; ``lang`` becomes the prediction."""
    model = langid.train(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    found = langid.labelled(docs, model, F.struct(*docs.columns).alias("__row"))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= SURE_LANGUAGE))
    return kept.select(*[F.col("lang_pred" if c == "lang" else f"__row.`{c}`").alias(c) for c in docs.columns])


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies (a row with a null id only where no other is in the group).

    Pairs come from SimHash fingerprints by a walk of their trie and are checked exactly: word shingles with a
    Jaccard similarity of LIKE percent or more. As fingerprints within a few bits miss most pairs near that
    bound, the exact product of shingle sets then links what the fingerprints leave apart.
    """
    return overlap.first_of_each(docs, SHINGLE, LIKE)


@tidy
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut byte strings that an earlier document has; documents with nothing left go.

    A character that is cut in part goes as a whole. Rows with one doc_id and one text are cut alike.
    """
    key = ["__id", "__none", "__tid"]

    def texts(batches):
        for batch in batches:
            for data, nulls, starts in zip(batch.column("data"), batch.column("nulls"), batch.column("starts")):
                null, ids, hashes, left = nulls.as_py(), [], [], []
                for k, doc_id, text, stays in suffix.kept_parts(data.as_py(), starts.as_py()):
                    ids.append(None if null[k] else doc_id)
                    hashes.append((xxhash.xxh64_intdigest(text.tobytes(), 42) + (1 << 63)) % (1 << 64) - (1 << 63))
                    left.append(text[stays].tobytes().decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(left, pa.string())], names=["id", "__tid", "cut"])

    def keyed(rows: DataFrame, doc_id: Column, *others) -> DataFrame:
        return rows.select(F.coalesce(doc_id, F.lit(0)).alias("__id"), doc_id.isNull().alias("__none"), *others)

    cut = keyed(suffix.Sorted(docs).cuts().mapInArrow(texts, "id long, __tid long, cut string"), F.col("id"), "__tid", "cut").dropDuplicates(key)
    rest = keyed(docs, F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__tid"), F.struct(*[c for c in docs.columns if c != "text"]).alias("__row"))
    joined = cut.where("trim(cut) <> ''").join(rest, key)
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return joined.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


@tidy
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold the text of a benchmark item."""
    return decontam.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


@tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in as few sequences as possible."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), lowers=False, end=2)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]
#: SQL has no Viterbi search, latent search or packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written and read again."""
    docs, before = read_table(in_utc(spark), sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        discard(spark, before)
        before = [(path, None)]
    return STAGES[-1][1](spark, docs, sf_dir)
