"""The documents of a corpus, cleaned and packed: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import decontaminate, language, line_runs, ngram_join, packing
from daygrain.llm.tables import table, tokenizer_path, unused
from daygrain.session import cut, fresh_folder, short_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known surely enough; the others go."""
    # The decision depends on the text alone, so it goes by the text: rows may lack an id or share one.
    (text_hash,) = unused(docs.columns, "_rejected")
    with short_batches(spark):
        found = language.languages(docs, language.learn(docs))
        rejected = cut(found.where("rejected").select("text_hash").distinct()).toDF(text_hash)
    return docs.join(rejected, F.xxhash64(docs["text"]) == F.col(text_hash), "left_anti").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that a later one of many holds too."""
    done = line_runs.line_dedup(docs.select("doc_id", "text", F.struct("*").alias("row")))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class, rows without an id last.

    Of rows with equal text and id one stays, with or without an id. Rows that share an id are
    compared like any others.
    """
    key, again_id = unused(docs.columns, "_key", "_again")
    again = cut(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(again_id)))
    is_again = F.col("doc_id") == F.col(again_id)
    plain = docs.where("doc_id IS NOT NULL").join(again, is_again, "left_anti").withColumn(key, F.col("doc_id"))
    # Rows whose id does not tell them apart go by a hash, below the other keys as far as ids are not negative.
    odd = docs.where("doc_id IS NULL").unionByName(docs.join(again, is_again, "left_semi"))
    odd = cut(odd.withColumn(key, -F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"), 1) - 1).dropDuplicates([key]))
    rows = plain.unionByName(odd)
    with short_batches(spark):
        found = ngram_join.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    own = odd.select(F.col(key).alias("key"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key")).alias("own"))
    usual = F.struct(F.lit(False).alias("none"), F.col("key").alias("id"), F.col("key"))
    ranked = cut(found.join(own, "key", "left").select("key", "component_id", F.coalesce("own", usual).alias("rank")))
    first = ranked.groupBy("component_id").agg(F.min("rank").alias("first"))
    gone = cut(ranked.join(first, "component_id").where("key <> first.key").select(F.col("key").alias(key)).distinct())
    return rows.join(gone, key, "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by its own text, with or without an id."""
    found = decontaminate.leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    (text_hash,) = unused(docs.columns, "_leaked")
    leaked = cut(found.select("doc_id").distinct()).toDF(text_hash)
    return docs.join(leaked, F.xxhash64(docs["text"]) == F.col(text_hash), "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    with short_batches(spark):
        return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Language ID and packing cannot be said in SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = fresh_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
