"""A training corpus from ``documents``: quality rules, near-duplicate removal, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet into the
shared checkpoint folder and reads it again as the next stage's documents. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import jaccard, mixing, packing, quality, suffixes
from blotter.llm.common import fresh, table
from blotter.llm.queries import MIX_SEED, PACK_VOCABULARY, SOURCE_WEIGHTS
from blotter.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; rows without an id stay."""
    others = jaccard.similar_documents(docs).filter("doc_id <> component_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also start earlier go from the texts; ``n_chars`` follows."""
    out = suffixes.remove_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go so that the sources get their weights; all columns stay, whatever their names."""
    names = {"copy": fresh(docs.columns, "copy"), "shuffle_key": fresh(docs.columns, "shuffle_key")}
    return mixing.mix(docs, SOURCE_WEIGHTS, seed=MIX_SEED, **names).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, PACK_VOCABULARY)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("suffix-array dedup", suffix_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can't express the bounds, the tokenizer and the packing; tests/llm/test_pipeline.py has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
