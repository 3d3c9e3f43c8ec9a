"""The registered queries of this package: name -> f(spark, sf_dir) -> DataFrame.

Each applies one operator with production parameters to its whole table and derives the result's
columns from the operator's output. ``ORACLE`` has DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import (
    class_ngrams,
    html_blocks,
    jaccard_join,
    license_scan,
    merkle_log,
    minhash_dedup,
    mixing,
    oracle,
    order_minhash,
    packing,
    quality_llr,
    ranked_search,
    sharding,
    toxicity,
)
from staylens.llm.common import id_crc32

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- LM scoring -------------------------------------------------------------------------------


def op1_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_crc32() % 7 == 2, F.lit(False))
    model, vocabulary = class_ngrams.train(docs.where(~held_out))
    scored = class_ngrams.score(docs, model, vocabulary)
    return scored.withColumn("held_out", held_out)


# -- quality rules ----------------------------------------------------------------------------


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the documents that are labelled as good."""
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_llr.with_verdict(docs, trusted(spark, sf_dir)).drop("text")


# -- HTML extraction --------------------------------------------------------------------------


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# -- license scans ----------------------------------------------------------------------------


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


# -- mixing sources to target weights ---------------------------------------------------------

#: Share of the tokens for all sources, and for all languages, that aren't listed, NULL included. Where
#: a corpus has none of them the listed ones fill the sample in proportion, and the other way round.
REST_SHARE = 0.1


def _beside_rest(shares: dict[str, float]) -> dict[str, float]:
    return {value: share * (1 - REST_SHARE) for value, share in shares.items()}


#: Token shares. Unlisted values get what these leave, REST_SHARE. Every text has one of the topics.
SOURCE_SHARES = _beside_rest({"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)})
LANG_SHARES = _beside_rest({"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.15})
TOPIC_SHARES = {"table": 0.04, "note": 0.12, "article": 0.44, "long": 0.40}
MIX_TARGETS = {"source": SOURCE_SHARES, "lang": LANG_SHARES, "topic": TOPIC_SHARES}


def topic():
    """The form of a text: a table, or prose by length."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.length(text) < 1500, "note")
        .when(F.length(text) < 8000, "article")
        .otherwise("long")
    )


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    mixed = mixing.with_probability(docs, MIX_TARGETS, values={"topic": topic()})
    return mixed.select(
        "doc_id", "source", "lang", topic().alias("topic"), "n_tokens", F.round("probability", 9).alias("probability"), "kept"
    )


# -- document fingerprints --------------------------------------------------------------------


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_check(_table(spark, sf_dir, "documents"))


# -- sharding ---------------------------------------------------------------------------------

SHARDS = 8


def op7_jump_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.with_shard(_table(spark, sf_dir, "documents"), SHARDS).withColumn("law", F.lit("key"))


# -- toxicity ---------------------------------------------------------------------------------


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """Fitted on the labelled rows of ``docs`` outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").where("doc_id is not null").where(id_crc32() % 3 != 1)
    return toxicity.train(docs, labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.with_score(docs, toxicity_model(spark, sf_dir, docs), keep=["doc_id"], score="score")
    return scored.select(
        "doc_id",
        F.coalesce(id_crc32() % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# -- packing ----------------------------------------------------------------------------------


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


# -- n-gram Jaccard join ----------------------------------------------------------------------


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


# -- ranked lexical search --------------------------------------------------------------------


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# -- MinHash near-duplicates ------------------------------------------------------------------


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_components(_table(spark, sf_dir, "documents"))


# -- Merkle dataset manifest ------------------------------------------------------------------


def op13_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_log.proofs(merkle_log.build(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_class_lm": op1_class_lm,
    "op2_quality_llr": op2_quality_llr,
    "op3_line_blocks": op3_line_blocks,
    "op4_license_scan": op4_license_scan,
    "op5_mix": op5_mix,
    "op6_order_minhash": op6_order_minhash,
    "op7_jump_hash": op7_jump_hash,
    "op8_toxicity": op8_toxicity,
    "op9_pack": op9_pack,
    "op10_jaccard": op10_jaccard,
    "op11_ranked_search": op11_ranked_search,
    "op12_minhash": op12_minhash,
    "op13_merkle_log": op13_merkle_log,
}

ORACLE: dict[str, str] = {
    "op5_mix": oracle.mixing_sql(MIX_TARGETS, mixing.KEEP_SHARE, mixing.SWEEPS, mixing.SEED),
    "op7_jump_hash": oracle.sharding_sql(SHARDS),
    "op10_jaccard": oracle.jaccard_sql(jaccard_join.N, jaccard_join.PERCENT),
    "op11_ranked_search": oracle.ranked_search_sql(ranked_search.K),
    "op12_minhash": oracle.minhash_sql(minhash_dedup.N, minhash_dedup.PERCENT),
    "op13_merkle_log": oracle.merkle_sql(),
}
