"""A text-cleaning pipeline made of the operators in ``tickloom.llm``."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, packing, pii, quality, similar
from tickloom.llm.common import stored
from tickloom.session import apply_settings

#: Text handed to Python workers at once; what they hold grows with it.
BATCH_BYTES = "16m"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go, equal rows share their fate, no row gives no row."""
    return quality.kept_rows(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): that with the smallest doc_id.

    SimHash links name candidates, and as 64 bits miss pairs near 0.8, minima of the
    shingles' hashes name more; an exact comparison decides. Equal rows leave one, rows
    without doc_id stay, no row gives no row.
    """
    return similar.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay, equal rows share their fate, no row gives no row."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms in place of personal data; other columns stay as they are, n_chars too.

    The key is the session setting ``spark.tickloom.pii.secret`` (Spark hides settings
    of such names in its pages); without it the test key, which anyone can undo.
    """
    key = spark.conf.get("spark.tickloom.pii.secret", "").encode() or pii.TEST_KEY
    return pii.pseudonymised(docs, key)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place. Null texts count as empty, equal rows are packed each."""
    return packing.pack_documents(docs)


def _settled(stage):
    """A stage under the library's session settings and small batches."""
    @functools.wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)
    return call


STAGES = [(name, _settled(stage)) for name, stage in [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("best_fit_packing", best_fit_packing),
]]

#: SimHash, string tiling, keyed permutation and tokenizing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
