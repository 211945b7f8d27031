"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes as Parquet and rereads as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import language, lines, mixing, near_dups, packing
from riskframe.llm.common import prepare, table
from riskframe.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise (operator 9)."""
    prepare(spark)
    model = language.fit(docs)
    return language.identify(docs, model).where("NOT rejected").select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that align with an earlier document (operator 10)."""
    prepare(spark)
    return lines.deduped(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 8)."""
    prepare(spark)
    return near_dups.representatives(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their mixing rate says (operator 5); the targets
    flatten the languages' shares and no document's rate falls below one."""
    prepare(spark)
    mixed = mixing.mix(docs, mixing.labelled_by_language(docs), least=1.0)
    return mixing.repeated(mixed, docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens (operator 3)."""
    prepare(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup),
          ("mix_to_targets", mix_to_targets), ("best_fit_packing", best_fit_packing)]

#: models, alignments and packing: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
