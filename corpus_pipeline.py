"""The corpus pipeline: each stage takes the documents its predecessor kept and returns documents, the last one packs.

* quality_rules: documents that the rules reject go; null and empty texts are among them.
* line_dedup: repeated lines go from texts; every document stays, also one without any line left. Rows with a null
  doc_id keep all lines.
* near_dedup: of each group of near-duplicates the smallest doc_id stays; repeated rows of a document that stays all
  stay, as do null doc_ids and documents without words.
* mixing: documents repeat whole, as often as their source's target takes them; a null source is one source.
* packing: token sequences of the mixed documents; an empty text is its end id alone.

No stage depends on the order of rows; ties go by the rules of its operator. An empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corvane.llm import common, line_dedup, mixing, near_dedup, packing, quality_rules


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Seeded sampling, sketches and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again by the next."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        with common.scope():
            stage(spark, out, sf_dir).write.parquet(f"{place}/{k}-{name}")
        if k:
            common.drop_path(spark, f"{place}/{k - 1}-{STAGES[k - 1][0]}")
        out = spark.read.parquet(f"{place}/{k}-{name}")
    common.keep_until_exit(spark, place)
    return out
