"""The registered queries: each operator on its whole table, and the oracle where SQL has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    bpe,
    collocations,
    decontamination,
    near_dedup,
    page_text,
    quality_rules,
    reply_trees,
    rule_ensemble,
    sharding,
    substring_dedup,
    token_counts,
    url_reputation,
    vector_codes,
)
from larder.llm.common import read
from larder.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(quality_rules.ledger(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_upper", "fail_bits")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicated(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that contain benchmark items, one row for each pair."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, read(spark, sf_dir, "benchmark"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, path, read_back=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    return rule_ensemble.scored(docs, rule_ensemble.fit(docs, labels))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.placed(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema))
    out = reply_trees.formatted(reply_trees.chained(turns)).select(
        "conv_id", "formatted", reply_trees.parsed(F.col("formatted")).alias("turns"),
        F.array_join(reply_trees.masked(F.col("formatted"), F.col("loss_spans")), "")
        .alias("learnt"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.classified(docs)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.counted(docs, path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


#: The rules of the query, as the contract states them, and the shared suffixes of its hosts.
URL_RULES = [
    url_reputation.Rule("allow", "com", "/"),
    url_reputation.Rule("block", "example.com", "/en/"),
    url_reputation.Rule("allow", "www.example.com", "/en/"),
    url_reputation.Rule("block", "net", "/es/"),
    url_reputation.Rule("block", "net", "/fr/"),
]
SHARED_SUFFIXES = ["example.com", "example.net", "example.org"]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the quality that ``labels`` has for its id."""
    outcome = read(spark, sf_dir, "labels").groupBy("doc_id").agg(
        (F.min("quality") == 0).cast("int").alias("bad"))
    pages = read(spark, sf_dir, "pages").select("page_id", "url").join(
        outcome, F.col("page_id") == F.col("doc_id"), "left").drop("doc_id")
    return url_reputation.judged(pages, URL_RULES, SHARED_SUFFIXES)


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_text.extracted(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs, least=100, top=2000)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, books = vector_codes.compressed(vectors, parts=4, entries=256, rounds=4)
    hexes = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return vector_codes.label_errors(codes).select(
        "vec_id", F.array_join(hexes, "").alias("code"), "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_sharding": op6_sharding,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_url_filters": op10_url_filters,
    "op11_page_text": op11_page_text,
    "op12_collocations": op12_collocations,
    "op13_vector_codes": op13_vector_codes,
}
