"""The registered queries of the training-data operators, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm import (
    decontaminate,
    exact,
    language,
    licenses,
    merkle,
    neighbours,
    packing,
    quality,
    secrets,
    simhash,
    substring,
    toxicity,
    whitening,
)
from auditloom.llm.folds import fold, held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and licence notice that it holds."""
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item that it holds."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose vec_id is divisible by 20."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the word sequences that start more than once."""
    return substring.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.filter(fold(4) != 2))
    # the fold needs doc_id only, so it is taken from the result
    found = language.predict(docs, model)
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score", "ambiguous")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, and those that the Markov models add."""
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four of five folds."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(fold(5) != 0)
    found = toxicity.score(docs, toxicity.train(docs, labels))
    return found.select("doc_id", held_out(5, 0), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of four of five folds."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    labels = _table(spark, sf_dir, "labels").filter(fold(5) != 0)
    return quality.score(docs, quality.train(docs, labels, pages), pages)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, proof and check of every document."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, and which of its equals stays."""
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_packing,
        op3_decontamination,
        op4_nearest_neighbours,
        op5_substring_dedup,
        op6_language_id,
        op7_secret_scan,
        op8_toxicity,
        op9_quality,
        op10_simhash_near_dedup,
        op11_whitening,
        op12_merkle_manifest,
        op13_exact_dedup,
    )
}

# for queries that SQL can express
ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licenses.sql(),
    "op12_merkle_manifest": merkle.sql(),
    "op13_exact_dedup": exact.SQL,
}
