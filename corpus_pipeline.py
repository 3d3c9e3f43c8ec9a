"""Corpus preparation in five stages: documents in, packed token pieces out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and
read back as the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import jaccard_join, mixing, packing, quality_llr, queries, toxicity
from staylens.llm.common import goes_with_application, rows_that_pass, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    good = queries.trusted(spark, sf_dir)
    return rows_that_pass(docs, quality_llr.RESULTS, lambda d: quality_llr.with_verdict(d, good).where("kept"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold."""
    model = queries.toxicity_model(spark, sf_dir, docs)
    return rows_that_pass(
        docs, ["toxicity"], lambda d: toxicity.with_score(d, model).where(F.col("toxicity") < toxicity.THRESHOLD)
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return jaccard_join.keep_one_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares follow the target mix."""

    def draw(rows: DataFrame) -> DataFrame:
        return mixing.with_probability(rows, queries.MIX_TARGETS, values={"topic": queries.topic()}).where("kept")

    return rows_that_pass(docs, mixing.RESULTS, draw)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with each result written to the shared folder. The tables go when the
    application ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = f"{shared_dir(spark)}/staylens/{uuid.uuid4().hex}-pipeline"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{i}")
        goes_with_application(spark, top)
        docs = spark.read.parquet(f"{top}/{i}")
    return docs
