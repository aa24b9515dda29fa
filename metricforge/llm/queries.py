"""The contract queries: each reads its whole table through its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    mixing,
    packing,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    token_store,
    toxicity,
    warc,
    whitening,
)
from metricforge.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The pages table has no fetch times.
FETCHED = "2024-01-01T00:00:00Z"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.find_copies(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM t WINDOW same AS (PARTITION BY text_sha256)"""


@query
def op3_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave(load(spark, sf_dir, "documents"), shards=40, seed=42)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


ORACLE["op3_interleaved_shards"] = sharding.interleave_sql(40, 42)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(load(spark, sf_dir, "documents"), RANKS, decode=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op4_suffix_dedup"] = suffix_dedup.remove_repeats_sql(200)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    path = token_store.fresh_path(spark)
    token_store.write_store(docs, TOKENIZER, path, end_id=2)
    return token_store.read_ids(docs.select(F.col("doc_id").alias("key")), path, unkeyed=True).drop("ids")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(load(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=0)
    return packing.pack(pieces, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op6_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(load(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLE["op6_subspace_pigeonhole"] = embedding_dedup.near_vectors_sql(0.93)


@query
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derive(warc.responses(load(spark, sf_dir, "pages"), FETCHED))
    return out.withColumn("head_sha256", F.sha2("head", 256)).drop("head", "block")


ORACLE["op8_warc_derivatives"] = warc.derive_sql(FETCHED)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    grade = F.expr("array_position(__mf_grades, array_max(__mf_grades)) - 1").cast("int")
    return out.select("doc_id", grade.alias("grade"), F.round("__mf_severity", 6).alias("expected_severity"),
                      F.col("__mf_rejected").alias("rejected"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


ORACLE["op11_spelling_variants"] = spelling.variants_sql()


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"), components=16)


@query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op13_source_mixing"] = mixing.mix_sql()
