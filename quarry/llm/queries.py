"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, langid, licenses, mixing, ngramjoin, nndescent, pieces, quality, repair, riskrules, spotsigs, surrogates, tokencount, whitening
from quarry.llm.common import crc_mod, table, text_or_empty
from quarry.llm.oracle import ORACLE_SQL  # noqa: F401


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = langid.train(docs, ~held_out)
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 3) == 1
    model = quality.fit(quality.training_sample(docs, labels.where(~held_out)))
    rated = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return rated.select("doc_id", "held_out", "score", "predicted", "size_difference")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every whole text."""
    docs = table(spark, sf_dir, "documents")
    return tokencount.count_tokens(docs, pieces.Vocabulary.load(), keep=["doc_id"])


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by seeded merge-dropout, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents")
    vocabulary = pieces.Vocabulary.load()
    return bpe.encode(docs, vocabulary, keep=["doc_id"], lossless="lossless")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, in the order of their first position."""
    mixed = mixing.curriculum(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return (mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken",
                         F.round(F.array_min("copies.position"), 6).alias("first_position"))
            .repartitionByRange(F.col("first_position").asc_nulls_last(), "doc_id")
            .sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id"))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    rows = spotsigs.with_next(docs.withColumn("sigs", spotsigs.signatures(F.col("text"))), "doc_id", ["text", "sigs"])
    rows = rows.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_sigs", spotsigs.signatures(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced, and the types found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, types_column="entity_types", check_digit=True)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every whole text."""
    return licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every embedding at cosine 0.9."""
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under the 4-word Jaccard join."""
    return ngramjoin.linked_components(table(spark, sf_dir, "documents"), n=4, percent=85).withColumnRenamed("id", "doc_id")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every whole text, and whether certified rules keep it."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = riskrules.judge(docs, labels, strata=["lang"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "failed_rule")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 leading whitened components of every usable embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    return repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op9_sentencepiece": op9_sentencepiece,
    "op4_mixing": op4_mixing,
    "op8_spotsigs": op8_spotsigs,
    "op6_pii": op6_pii,
    "op7_licenses": op7_licenses,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op11_quality_rules": op11_quality_rules,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}
