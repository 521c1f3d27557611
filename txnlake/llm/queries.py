"""Registered queries of this package, one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlake.llm import (bpe, chat, decontaminate, embeddings, language, mixing, records, runs, secret_scan, sharding,
                         simhash, toxicity, whitening)
from txnlake.llm.common import fresh_folder, id_text, table, whole

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, through a ledger that starts empty."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(documents, fresh_folder(spark, "ledger"))
    count = lambda rule: F.coalesce(F.size(F.filter("findings", lambda one: one["rule"] == rule)), F.lit(0)).cast("long")
    spans = secret_scan.span_text(F.col("findings"))
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    documents = table(spark, sf_dir, "documents")
    return sharding.shard_documents(documents.select("doc_id", "text"), 24, keep_text=False).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_nearest_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, with the ids of the nearest examples."""
    scored = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted", F.col("evidence.id").alias("evidence_ids"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as prompt, completions and masks, against a reply that belongs to another one."""
    turns = table(spark, sf_dir, "conversations")
    pairs = chat.preference_pairs(turns, chat.swapped_replies(turns))
    masks = [chat.mask_text(F.col(name)).alias(name) for name in ("chosen_mask", "rejected_mask")]
    return pairs.select("pair_id", "prompt", "chosen", "rejected", *masks)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and groups of all documents."""
    marked = table(spark, sf_dir, "documents").select("doc_id", simhash.fingerprint(F.col("text")).alias("fingerprint"))
    return simhash.near_duplicates(marked).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings."""
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).select(
        "vec_id", "n_links", "component_id", "kept")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item it holds a passage of."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("one")).select("doc_id", "one.*")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and what they decode to, as digests."""
    coded = table(spark, sf_dir, "documents").select(
        "doc_id", bpe.round_trip(F.col("text"), public_tokenizers.path(WORD_VOCABULARY)).alias("coded"))
    return coded.select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("coded.ids", " "), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offset index of the records of all documents, read back from the files."""
    index = records.token_records(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path(BYTE_VOCABULARY))
    return index.select(F.col("row_id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of all documents the mix takes; good documents are drawn four times as often as bad ones."""
    known = table(spark, sf_dir, "labels").filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    qualities = known.groupBy("doc_id").agg(F.when(F.max("quality") == 1, 2.0).otherwise(0.5).alias("quality"))
    taken = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), qualities=qualities)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def _with_planted_runs(doc_id: str, text: str):
    """The text as the contract has it: in a tenth of the documents the words from one on repeat with some period."""
    # Lambda variables hold what would otherwise be worked out again for every word.
    planted = r"""transform(array(filter(split(whole, '[\\x20\\x09-\\x0D]+'), w -> w != '')), w -> CASE WHEN size(w) = 0 THEN '' ELSE
        transform(array(named_struct('a', g % size(w), 'p', 1 + (size(w) - g % size(w)) div (3 + g % 8))), at -> array_join(
            transform(sequence(0, size(w) - 1), i -> w[cast(if(i < at.a, i, at.a + (i - at.a) % at.p) AS int)]), ' '))[0] END)[0]"""
    h = F.crc32(F.encode(id_text(doc_id), "UTF-8"))
    return lambda rows: rows.select(doc_id, whole(text).alias("whole"), h.alias("h"), F.expr("0L").alias("g")).withColumn(
        "g", F.floor(F.col("h") / 10)).select(doc_id, F.when(F.col("h") % 10 == 0, F.expr(planted)).otherwise(F.col("whole")).alias("text"))


def op12_square_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, and what is left without their repeats, as digests."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").transform(_with_planted_runs("doc_id", "text"))
    found = runs.periodic_runs(documents).drop("text")
    longest = F.array_max(F.transform("runs", lambda one: F.struct(
        one["length"].alias("length"), (-one["start"]).alias("start"), (-one["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda one: F.concat(
        F.concat_ws(",", one["start"].cast("string"), one["length"].cast("string"), one["period"].cast("string")), F.lit("\n"))), "")
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("most"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return told.select("doc_id", "n_runs", (-F.col("most.start")).alias("start"), F.col("most.length").alias("length"),
                       (-F.col("most.period")).alias("period"),
                       F.floor(1000 * F.col("most.length") / -F.col("most.period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings, projected on the eight leading components and scaled to unit variance."""
    return whitening.whitened_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_secret_scan, op2_histogram_shards, op3_rank_order_language, op4_nearest_toxicity, op5_preference_format,
        op6_simhash, op7_embedding_tiles, op8_decontaminate, op9_bpe, op10_token_records, op11_source_mix, op12_square_runs,
        op13_whitening)
}
