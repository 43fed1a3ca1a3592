"""Registered queries of the operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.llm import (
    bpe, contamination, html, language, licenses, lines, neardup, negatives, periodic, quality, secrets, topk, toxicity,
)
from issuerlake.llm.common import bucket

REGISTRY = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_html_extraction(spark, sf):
    pages = table(spark, sf, "pages")
    return html.extract(pages, html.train(pages), ["page_id", "url"]).select("page_id", "url", "text", "n_chars")


@query
def op2_minhash_dedup(spark, sf):
    return neardup.link(table(spark, sf, "documents"), width=2, similarity=(80, 100))


@query
def op3_secret_scan(spark, sf):
    return secrets.digest(secrets.scan(table(spark, sf, "documents")))


@query
def op4_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(bucket("doc_id", 5) != 0)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select(
        "doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.fit(language.sample(docs.where(bucket("doc_id", 3) != 1)))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op6_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(bucket("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), F.col("toxic").alias("score"),
        (F.col("toxic") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "repeated", "dense",
    )


@query
def op7_bpe(spark, sf):
    import public_tokenizers

    return bpe.digest(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_exact_topk(spark, sf):
    vectors = topk.integers(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return topk.search(vectors.where(F.col("id") % 50 == 0), vectors, k=5)


@query
def op9_decontamination(spark, sf):
    return contamination.digest(contamination.search(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@query
def op10_license_scan(spark, sf):
    return licenses.digest(licenses.scan(table(spark, sf, "documents")))


@query
def op11_quality_rules(spark, sf):
    return lines.digest(lines.measure(table(spark, sf, "documents")))


@query
def op12_periodic_runs(spark, sf):
    return periodic.digest(table(spark, sf, "documents"), rewrite=periodic.repeat_tail)


@query
def op13_hard_negatives(spark, sf):
    rows = negatives.prepare(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows.where(F.col("id") % 100 == 0), rows)
