"""A corpus pipeline: toxic documents go, then near duplicates and leaks, secrets are masked, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlake.llm import bpe, decontaminate, secret_scan, simhash, toxicity
from txnlake.llm.common import fresh_folder, stage, table

VOCABULARY = "word_bpe_49k.json"
#: Characters of a text that a match must span to be a leak; single words and short phrases of a benchmark are none.
LEAST_LEAK = 40


def _packed(docs: DataFrame) -> DataFrame:
    """Documents as one struct beside what operators read, so no column name can clash."""
    return docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    scored = toxicity.toxicity(_packed(docs), table(spark, sf_dir, "labels"), keep=["doc_id", "_row"])
    return scored.filter("predicted = 0").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Documents without any word are near duplicates of each other.
    """
    marked = _packed(docs).withColumn("fingerprint", simhash.fingerprint(F.col("text"))).drop("text")
    return simhash.first_of_groups(marked).select("_row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item of 40 characters or more."""
    found = decontaminate.contamination(_packed(docs), table(spark, sf_dir, "benchmark"))
    leaks = F.filter("matches", lambda one: one["end"] - one["start"] >= LEAST_LEAK)
    return found.filter(F.size(leaks) == 0).select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; n_chars follows the text."""
    found = secret_scan.scan(_packed(docs), fresh_folder(spark, "ledger"))
    found = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col("findings")))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("findings") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("_row.n_chars"))
    return found.select(*[changed.get(name, F.col("_row").getField(name)).alias(name) for name in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of what the ids decode to."""
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), public_tokenizers.path(VOCABULARY)).alias("coded"))
    return coded.select("doc_id", "coded.ids", F.size("coded.ids").cast("long").alias("n_tokens"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", mask_secrets),
    ("bpe encoding", encode),
]

# Nearest examples, fingerprints and alignments have no SQL form; tests/llm compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
