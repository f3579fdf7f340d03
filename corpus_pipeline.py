"""The corpus pipeline: five operators of ``tidemark.llm`` one after the other, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, language, pieces, simhash, suffixes, tables

#: (name, function of (spark, docs, folder of the tables)); each gets what the one before kept.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language.stage),
    ("SimHash near-dedup", simhash.stage),
    ("suffix-array dedup", suffixes.stage),
    ("benchmark decontamination", decontamination.stage),
    ("SentencePiece encoding", pieces.stage),
]

#: Language prediction, suffix sorting and piece encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    with tables.Staging(spark, "pipeline") as staging:
        for i, (_, stage) in enumerate(STAGES):
            docs = staging.put(stage(spark, docs, sf_dir), f"stage{i}", keep=i == len(STAGES) - 1)
    return docs
