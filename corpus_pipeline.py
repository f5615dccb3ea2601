"""A corpus cleaned and packed in five stages.

Quality rules, line dedup, n-gram Jaccard join, benchmark decontamination and best-fit packing; each stage
works on all that the one before has kept, stored as Parquet in between.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, jaccard_join, line_quality, packing, site_lines
from ordermill.llm.queries import read
from ordermill.llm.store import held
from ordermill.session import size_shuffles


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return line_quality.keep(docs, line_quality.fit(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines; ``n_chars`` follows the text."""
    return site_lines.drop_boilerplate(docs, least_pages=1).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens go in sequences of at most 2048."""
    return packing.pack(docs)


#: Documents in a batch between the JVM and Python: both hold one or two, of a task each.
BATCH_ROWS = 2_000


def _bounded(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _bounded(quality)),
    ("line dedup", _bounded(lines)),
    ("n-gram Jaccard join", _bounded(near_duplicates)),
    ("benchmark decontamination", _bounded(decontaminated)),
    ("best-fit packing", _bounded(packed)),
]

#: The quality stage decodes a trained model, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # Shuffles of texts in partitions of 128 MB; AQE merges small ones and cannot split large ones.
    size_shuffles(spark, docs.agg(F.sum("n_chars")).first()[0] or 0, growth=1.0)
    for name, stage in STAGES:
        docs = held(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
