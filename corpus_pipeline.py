"""From raw documents to a training mix: each stage calls one operator on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, staged, without
from daybridge.llm.decontam import decontaminate, is_contaminated
from daybridge.llm.exactdedup import exact_dedup
from daybridge.llm.langid import identify
from daybridge.llm.mixing import mix
from daybridge.llm.simhash import simhash_components
from daybridge.session import drop_folder, shared_folder, work_folder

# A document goes when no language has this share of it.
LEAST_SHARE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without any letter, and those where no language prevails, go."""
    found, name = identify(docs, docs)
    return (found.where((F.col(f"{name}.lang") != "und") & (F.col(f"{name}.score") >= LEAST_SHARE))
            .select(*docs.columns))


def _kept(docs: DataFrame, told: DataFrame, placed: DataFrame, place: list[str]) -> DataFrame:
    return without(placed, place, staged(told.where("not kept").select(*place))).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest doc_id."""
    return _kept(docs, *exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id."""
    return _kept(docs, *simhash_components(docs))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    found, name = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~is_contaminated(name)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the training mix takes of each document."""
    return mix(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]

# Learned languages and bit distances are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again.

    What a stage left in the work folder goes when its result is written, and so does the result before.
    """
    docs, last = corpus_session(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        with work_folder(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if last:
            drop_folder(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
