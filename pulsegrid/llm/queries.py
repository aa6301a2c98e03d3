"""The registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontamination, hard_negatives, language_id, minhash, mixing, packing, quality_pu, quality_rules, secret_scan, simhash, substring_dedup, vector_codes, warc
from pulsegrid.llm.common import documents, held_out


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a passage within a fifth of the item's words in edit distance."""
    return decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by positive-unlabelled learning; folds by crc32 of the id."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_pu.fit(docs.where(~held_out()), labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id"))
    return quality_pu.predict(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by averaged subword embeddings; folds by crc32 of the id."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~held_out()))
    return language_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op4_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in packed rows of 2,048, with segment ends, position resets and documents."""
    return packing.packed(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality rules and zstandard compression bands of every document."""
    return quality_rules.rules(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 over the sources, each document at most three times."""
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns, and random strings by Markov models trained on the corpus."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spans = secret_scan.scan(docs, secret_scan.train(secret_scan.labelled(docs)))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = F.array_sort(F.concat("base", "added"))
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"), secret_scan.listed(joined).alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), width=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that also start earlier."""
    found = substring_dedup.remove(documents(spark, sf_dir).select("doc_id", "text"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and merged into the capture index."""
    index = warc.archive_and_index(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and its five positives, 30 to 90 percent as near as the positive."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every document and of its text edited with the next one, and their likeness."""
    return minhash.with_edits(documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-quantisation codes of all vectors: 16 parts, 64 entries, 2 rounds."""
    coded, books = vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))
    found = vector_codes.with_label_error(coded)
    digest = F.lit(books.digest() if books else None).cast("string")
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_quality_classifier, op3_language_id, op4_token_packing, op5_quality_rules, op6_mixing, op7_secret_scan, op8_simhash, op9_substring_dedup, op10_warc, op11_hard_negatives, op12_minhash, op13_vector_codes)}
ORACLES: dict[str, str] = {"op6_mixing": mixing.ORACLE, "op9_substring_dedup": substring_dedup.ORACLE, "op10_warc": warc.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE, "op13_vector_codes": vector_codes.ORACLE}
