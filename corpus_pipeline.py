"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, suffix-array
dedup, best-fit packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the
stage before it kept. All but the last return the columns of ``docs``; the
last returns the place of every piece of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.llm import exact_dedup, packing, simhash, suffix_dedup, toxicity
from metricforge.llm.common import columns, keep
from metricforge.llm.queries import TOKENIZER
from metricforge.session import clean, scratch
from metricforge.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(~F.col("__mf_rejected")).select(*columns(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2, seed=42)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeats(docs, length=200)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, TOKENIZER, capacity=2048, end_id=0)
    return packing.pack(pieces, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", strip_repeats),
    ("best_fit_packing", pack),
]

#: Ordinal regression, BPE and SimHash are not SQL; the stages are tested
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's input and intermediates are removed
    once its result is written, so the shared folder holds two stages at most."""
    docs, held = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = [*scratch(spark)]
        docs = keep(stage(spark, docs, sf_dir), name)
        *done, result = (p for p in scratch(spark) if p not in before)
        clean(spark, [p for p in done if "dedup-state" not in p] + ([held] if held else []))
        held = result
    return docs
