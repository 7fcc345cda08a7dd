"""The corpus pipeline: filtering and shaping stages over `documents`.

Each stage takes what its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import language, line_dedup, ngram_join, packing
from tillmart.llm.common import written

# A text whose language gets less than this of the evidence is rejected.
LEAST_SCORE = 0.3

# So is a text that has so few known words as happens to one in exp(MOST_DOUBT), a million and
# more, of which half as many words are known as of texts in its language.
MOST_DOUBT = 14.0

# A document goes if so many in a hundred of its signs are in earlier documents, as near copies do.
MOST_REPEATED = 80


def _aside(docs: DataFrame, names: list[str]) -> DataFrame:
    """The documents, with columns of these names called otherwise for a while."""
    return docs.withColumnsRenamed({name: f"_given_{name}" for name in names})


def _back(found: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of the documents under their own names."""
    renamed = found.drop(*names).withColumnsRenamed({f"_given_{name}": name for name in names})
    return renamed.select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones; a missing label is filled in.

    Rejected are texts without a letter, null ones included, and those no language claims with
    LEAST_SCORE, or of which hardly a word is known, beyond MOST_DOUBT; a short text in a language
    without labels stays, as it tells too little. Without any labelled document nothing can be identified, and all go.
    """
    found = language.identify(_aside(docs, language.ADDED), language.learn(docs))
    accepted = found.filter(
        (F.col("lang_pred") != language.UNDETERMINED)
        & (F.col("score") >= LEAST_SCORE)
        & (F.col("doubt") <= MOST_DOUBT)
    )
    filled = accepted.withColumn("lang", F.coalesce("lang", "lang_pred"))
    return _back(filled, docs, language.ADDED)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has; n_chars follows.

    A document goes if no text is left of it, or if it lost MOST_REPEATED in a hundred of its signs,
    lines that it repeats itself counted once: the rest of a near copy is no document. One that lost
    no line stays whatever it holds.
    """
    names = [*line_dedup.ADDED, "n_own"]
    own = F.length(F.array_join(F.array_distinct(F.split("text", "\n")), "\n"))
    # Written first, so that the lines are not put together again for the filter.
    cleaned = line_dedup.dedup_lines(_aside(docs, names).withColumn("n_own", own))
    cleaned = written(cleaned, "cleaned-documents")
    lost = (F.col("n_own") - F.length("text")) * 100 >= F.col("n_own") * MOST_REPEATED
    left = cleaned.filter((F.col("n_dropped") == 0) | ((F.trim("text") != "") & ~lost))
    counted = left.withColumn("n_chars", F.length("text").cast("long"))
    return _back(counted, docs, names)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word n-grams, 0.8 and more alike, the one of smallest id.

    Rows of the same id and text are one document. Other rows of the same id all stay or all
    go; so do rows with a null id, which go if each of them is linked to an id.
    """
    kept = ngram_join.similar_documents(docs, width=5, percent=80).filter("is_kept")
    kept = written(kept.select(F.col("doc_id").alias("_kept_id")).distinct(), "kept-documents")
    staying = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
    marked = staying.withColumn("_text", F.xxhash64("text"))
    return marked.dropDuplicates(["doc_id", "_text"]).select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of token ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("similar", keep_one_of_similar),
    ("packing", pack_documents),
]

# Language models, tokenizers and least squares have no SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
