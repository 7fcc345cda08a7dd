"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import (
    bpe,
    chat,
    embedding_links,
    language,
    line_dedup,
    ngram_join,
    packing,
    pseudo_likelihood,
    source_divergence,
    token_rollup,
    url_rules,
    vector_search,
    whitening,
)
from tillmart.llm.common import shared_folder, written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links.near_vectors(_table(spark, folder, "embeddings"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = language.learn(documents, ~language.held_out())
    return language.identify(documents.select("doc_id", "text"), model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "n_words"
    )


def op4_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.score_documents(_table(spark, folder, "documents"))


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, folder, "documents"), width=4, percent=85)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


# The contract's extra conversation: control strings inside its texts.
EXTRA_CONVERSATION = -1
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    read = chat.read_back(chat.format_conversations(given.unionByName(extra)))
    line = F.lit("\n")
    told = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    learned = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_decode(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Load all documents, withdraw the toxic ones, recount those of low quality, replay."""
    version, with_end = "word-bpe-49k", "word-bpe-49k-end"
    counts = token_rollup.token_counts(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), version
    )
    counts = written(counts, "token-counts")
    labels = _table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    judged = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    known = written(counts.join(judged, "doc_id"), "judged-counts")
    toxic = known.filter("toxic = 1")
    low = known.filter("quality = 0 AND coalesce(toxic, 0) <> 1")
    ended = low.withColumns({"tokenizer": F.lit(with_end), "tokens": F.col("tokens") + 1})
    rollup = token_rollup.TokenRollup(spark, shared_folder(spark, "token-rollup"))
    for _ in range(2):  # the second time every batch is known already
        rollup.commit("1-load", token_rollup.inserted(counts))
        rollup.commit("2-withdraw", token_rollup.deleted(toxic))
        rollup.commit("3-recount", token_rollup.revised(low, ended))
    return rollup.totals()


def op9_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_rules.rules_table(spark, url_rules.RULES)
    judged = url_rules.judge(_table(spark, folder, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "decided_by")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.whitened_rows(vectors, scale=64, offset=1_000_000, most_components=32)


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.divergence(_table(spark, folder, "documents"))


QUERIES = {
    "op1_embedding_links": op1_embedding_links,
    "op2_language": op2_language,
    "op3_line_dedup": op3_line_dedup,
    "op4_pseudo_likelihood": op4_pseudo_likelihood,
    "op5_ngram_join": op5_ngram_join,
    "op6_chat_format": op6_chat_format,
    "op7_bpe": op7_bpe,
    "op8_token_rollup": op8_token_rollup,
    "op9_vector_search": op9_vector_search,
    "op10_packing": op10_packing,
    "op11_url_rules": op11_url_rules,
    "op12_whitening": op12_whitening,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {
    "op1_embedding_links": embedding_links.SQL_TEXT,
    "op3_line_dedup": line_dedup.SQL_TEXT,
    "op5_ngram_join": ngram_join.SQL_TEXT,
    "op6_chat_format": chat.SQL_TEXT,
    "op9_vector_search": vector_search.SQL_TEXT,
    "op11_url_rules": url_rules.SQL_TEXT,
    "op13_source_divergence": source_divergence.SQL_TEXT,
}
