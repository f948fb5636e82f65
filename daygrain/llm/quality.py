"""Document quality by hierarchical empirical Bayes: the text's own evidence with what is known of its site.

A host's share of good documents is shrunk towards the global share, and a path's towards its
host's: the fewer labelled documents a site has, the more it takes from above. How strongly is
estimated from the spread of the sites themselves (beta-binomial moments). The classifier adds its
log odds, less those of the prior it was trained under.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm import subword
from daygrain.llm.language import HELD_OUT, fold
from daygrain.session import cut

#: Whole texts of each class to learn from; twice as many calibrate.
PER_CLASS = 800
#: The classifier's log odds count up to this; beyond, it is one voice among the evidence.
MOST_LOG_ODDS = 8.0


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, prior: Column) -> float:
    """How many labelled documents the prior is worth, from how far the sites' shares stray from it.

    With n documents a site's share varies by p (1 - p) / n by chance alone; what it varies beyond
    that is the true spread s of the sites, and p (1 - p) / s - 1 the strength. Between 1 and 1000.
    """
    expected = F.sum(prior * (1 - prior))
    stray = F.sum(F.col("n") * (F.col("k") / F.col("n") - prior) ** 2)
    moments = sites.where("n > 0").select(expected.alias("e"), stray.alias("s"), F.sum("n").alias("n"), F.count("*").alias("m"), F.sum(prior * (1 - prior) * F.col("n")).alias("w")).first()
    if not moments["m"] or moments["n"] <= moments["m"] or not moments["w"]:
        return 1000.0
    spread = max(0.0, (moments["s"] - moments["e"]) / (moments["n"] - moments["m"]))
    return float(min(1000.0, max(1.0, moments["w"] / moments["n"] / spread - 1))) if spread else 1000.0


def posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Of (host, path, good): posterior share by host, by (host, path), and the global share.

    Counts only are grouped and shuffled, so a host with a third of all rows is a few rows by then.
    """
    paths = cut(labelled.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("k")))
    total = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    m = _strength(hosts, F.lit(overall))
    hosts = cut(hosts.select("host", ((F.col("k") + m * overall) / (F.col("n") + m)).alias("host_quality")))
    beside = paths.join(hosts, "host")
    m = _strength(beside, F.col("host_quality"))
    return hosts, cut(beside.select("host", "path", ((F.col("k") + m * F.col("host_quality")) / (F.col("n") + m)).alias("path_quality"))), overall


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, per_class: int = PER_CLASS, keep_from: float = 0.5) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) with its probability of good quality.

    ``labels``: (doc_id, quality 0 or 1). Learning, of texts and of sites, uses labelled documents
    outside the held-out quarter only; a document with contradicting labels counts with the lower.
    Columns: doc_id, held_out, text_quality, host_quality, path_quality, quality, kept.
    The text's log odds count up to MOST_LOG_ODDS either way, so that no text outweighs every site.
    Null and empty texts have no evidence of their own; sites without labels, and null hosts or
    paths (which are the site ''), have their parent's share. Without labels every quality is 0.5.
    Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    good = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    known = rows.where(fold() != HELD_OUT).select("doc_id", "host", "path").join(good, "doc_id")
    hosts, paths, overall = posteriors(known)
    taught = subword.sample(known.withColumn("label", F.col("good").cast("string")), per_class * subword.FOLDS / (subword.FOLDS - subword.CALIBRATING))
    taught = cut(taught.select("doc_id", "label").distinct())
    model = subword.train(rows.select("doc_id", "text").join(taught, "doc_id"), per_class)
    key = F.struct("doc_id", "host", "path", (F.length(F.coalesce("text", F.lit(""))) > 0).alias("filled"))
    scored = subword.score(rows, model, key, "struct<doc_id:bigint,host:string,path:string,filled:boolean>")
    if model.labels == ["0", "1"]:
        share = F.when(F.col("key.filled"), F.least(F.greatest(F.col("shares")[1], F.lit(1e-9)), F.lit(1 - 1e-9))).otherwise(0.5)
    else:
        share = F.lit(0.5)
    rows = scored.select("key.doc_id", "key.host", "key.path", share.alias("text_quality"))
    rows = rows.join(hosts, "host", "left").join(paths, ["host", "path"], "left")
    # The sample has as many of either class, so its prior odds are even.
    site = F.coalesce("path_quality", "host_quality", F.lit(overall))
    evidence = F.least(F.greatest(_logit(F.col("text_quality")), F.lit(-MOST_LOG_ODDS)), F.lit(MOST_LOG_ODDS))
    odds = evidence + _logit(site)
    quality_ = 1 / (1 + F.exp(-odds))
    return rows.select(
        "doc_id",
        F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        "text_quality",
        F.coalesce("host_quality", F.lit(overall)).alias("host_quality"),
        site.alias("path_quality"),
        quality_.alias("quality"),
        (quality_ >= keep_from).alias("kept"),
    )
