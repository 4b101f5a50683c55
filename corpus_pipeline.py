"""Corpus pipeline: quality rules, near duplicates, benchmark passages, personal data, mixing.

Every stage works on all that the stage before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triagelake.llm import decontaminate, mixing, pii, quality, shingle_join
from triagelake.session import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("kept").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id.  Wordless rows are no duplicates."""
    return shingle_join.keep_representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows."""
    return _with_length(decontaminate.find_benchmark(docs, _table(spark, sf_dir, "benchmark"), cut=True), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _with_length(pii.find_personal_data(docs, pii.fit(docs), mask=True), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's rate says, numbered by copy."""
    return mixing.repeated(mixing.mix_sources(docs)).select(*[c for c in docs.columns if c != "copy"], "copy")


def _with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return changed.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else c for c in docs.columns])


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("mixing sources", mixed),
]

#: The trained stages cannot be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs, "stage")
    return docs
