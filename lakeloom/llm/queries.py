"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import arc, decontam, digest, filters, katz, langid, overlap, packing, sharding, simhash, suffix, token_file, trie
from lakeloom.llm.common import read_table
from lakeloom.llm.token_file import tokenizer_path
from lakeloom.session import in_utc


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(in_utc(spark), sf_dir, "documents"), 40)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.round_trip(read_table(in_utc(spark), sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_all(read_table(in_utc(spark), sf_dir, "documents"))


def op10_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.digests(read_table(in_utc(spark), sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(in_utc(spark), sf_dir, "documents"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read_table(in_utc(spark), sf_dir, "documents"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removed(read_table(in_utc(spark), sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(in_utc(spark), sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(in_utc(spark), sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), lowers=False, end=2)


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.digest_query(spark, read_table(in_utc(spark), sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(read_table(in_utc(spark), sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.classes(read_table(in_utc(spark), sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes_of(read_table(in_utc(spark), sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_sharding, op2_language, op3_packing, op4_warc, op5_decontamination, op6_token_file, op7_katz, op8_simhash, op9_suffix, op10_digest, op11_filter_audit, op12_overlap_join, op13_prefix_trie)
}
ORACLES: dict[str, str] = {"op4_warc": arc.SQL, "op11_filter_audit": filters.SQL, "op12_overlap_join": overlap.SQL, "op13_prefix_trie": trie.SQL}
