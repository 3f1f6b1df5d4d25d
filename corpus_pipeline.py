"""Corpus pipeline: toxicity, language, near duplicates, repeated strings, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything the stage
before kept.  All but the last return the columns of ``documents``; the
pieces of the last say where every kept document lies in the sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joblens.llm import jaccard_join, language, packing, suffix_dedup, toxicity
from joblens.llm.common import free_name, saved, small_batches, table

#: Cosine that chance reaches about once in six times in this many dimensions;
#: a text below it has no language to speak of.
LEAST_COSINE = language.DIMENSIONS**-0.5

#: Near duplicates share so many percent of their shingles of so many words;
#: the values of ``op2_jaccard_join`` are that query's alone.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold.  Null and empty texts
    are scored like others; equal rows fare alike; without labels all stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    score = free_name(docs, "toxic_score")
    return toxicity.score(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those without letters, or no
    closer to any language than chance, go."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = language.predict(docs, language.train(docs), names_out=(lang, score))
    return found.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_COSINE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every component of linked documents, and one row
    of each doc_id and text: of rows equal in both (nulls count as equal) the
    one that comes first as JSON stays.  Other rows with a null doc_id, and
    texts without words, stay."""
    found = jaccard_join.jaccard_join(docs, NEAR_PERCENT, NEAR_WORDS)
    gone = saved(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Only rows whose key repeats are compared by their texts.
    key = free_name(docs, "_key")
    kept = kept.withColumn(key, F.xxhash64("doc_id", "text"))
    many = saved(docs.groupBy(F.xxhash64("doc_id", "text").alias(key)).count().where("count > 1").select(key), "copies")
    row = F.struct(*docs.columns)
    one = kept.join(many, key, "left_semi").groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("row"))
    return kept.join(many, key, "left_anti").select(*docs.columns).unionByName(one.select("row.*"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start earlier elsewhere; a null text
    stays null, and n_chars counts what is left."""
    into = free_name(docs, "_repeats")
    cut = suffix_dedup.remove_repeats(docs, into=into)
    text = F.when(F.col("text").isNotNull(), F.col(into)["readable"])
    columns = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cut.withColumns(columns).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens.  A
    null or empty text is one piece with the end id alone; equal rows are
    packed each; without documents there are no pieces."""
    return packing.pack_pieces(saved(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True), "pieces"))


STAGES = [
    (name, small_batches(stage))
    for name, stage in (
        ("toxicity", drop_toxic),
        ("language", drop_unknown_language),
        ("jaccard", drop_near_duplicates),
        ("suffix_dedup", cut_repeats),
        ("packing", pack),
    )
]

#: Trained classifiers and byte-level deduplication have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written and read again.
    Extra columns go along until the last stage, whatever their names; an empty
    table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
