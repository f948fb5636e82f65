"""Language identification with calibrated rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import subword

UNKNOWN = "und"
#: Whole texts of each language to learn from; twice as many calibrate.
PER_LANGUAGE = 400
HELD_OUT = 2


def fold(doc_id: str = "doc_id"):
    """Which quarter of the documents a row is in; null without a doc_id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> subword.Model:
    """A model of the languages of the rows with text, lang and doc_id that are not held out."""
    rows = docs.where(fold() != HELD_OUT).select("doc_id", "text", F.col("lang").alias("label"))
    return subword.train(rows, per_language)


def languages(docs: DataFrame, model: subword.Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected, text_hash) of every row of ``docs`` (doc_id, text; more columns are ignored).

    A text that is null or has no letter is ``und`` with score 0, and rejected. So is, with its own
    prediction kept, a text whose score or whose share of familiar subwords lies below the calibrated
    thresholds (``subword.train``). Held out is false for
    rows without doc_id. Every row gives a row; text_hash tells rows apart that have no id.
    """
    key = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.xxhash64("text").alias("text_hash"))
    scored = subword.score(docs, model, key, "struct<doc_id:bigint,letters:boolean,text_hash:bigint>")
    known = F.col("key.letters") & F.col("label").isNotNull()
    return scored.select(
        "key.doc_id",
        F.coalesce(fold("key.doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        F.when(known, F.col("label")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        (~known | (F.col("score") < model.reject_below) | (F.col("familiar") < model.least_familiar)).alias("rejected"),
        "key.text_hash",
    )
