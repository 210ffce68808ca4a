"""The operators' registered queries: each over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (alignment, centroids, chat, decontamination, language, licenses, merkle, mixing, near_duplicates, ngram_model, quality, substrings,
                        warc)
from encore.llm.common import id_remainder
from encore.sources.tables import read_table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with what stays of its text and the removed ranges."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    done, name = substrings.remove_repeats(docs)
    spans = F.col(name)["spans"]
    return done.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0).cast("long")).alias("n_removed"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed"),
        F.col(name)["text"].alias("text"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the square roots of their sources' sizes, as many rows as there are on average."""
    docs = _documents(spark, sf_dir)
    return mixing.mix(docs, mixing.source_rates(docs))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).select("doc_id", licenses.scan_licenses().alias("found"))
    matches = F.transform("found.matches", lambda m: F.concat(m["license"], F.lit(":"), m["start"], F.lit("-"), m["end"]))
    return found.select("doc_id", "found.license", "found.coverage", F.size("found.matches").alias("n_matches"),
                        F.array_join(matches, ",").alias("matches"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found, name = decontamination.find_contamination(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))
    r = F.col(name)
    return found.select(
        "doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"), F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(r["items"], ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(r["n_words"], r["n_hit"]).alias("contaminated"),
        F.array_join(F.transform(r["spans"], lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    model = language.fit(docs.where(~held_out))
    found = docs.withColumn("p", language.identify(spark, model))
    return found.select("doc_id", held_out.alias("held_out"), F.col("p")["lang"].alias("lang_pred"), F.col("p")["score"].alias("score"),
                        F.col("p")["rejected"].alias("rejected"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return near_duplicates.near_duplicates(docs).withColumnRenamed("id", "doc_id")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = id_remainder("doc_id", 10) == 0
    scores = ngram_model.score(spark, docs, ngram_model.fit(docs.where(~held_out)))
    return scores.withColumnRenamed("id", "doc_id").withColumn("held_out", held_out)


def op9_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    rows = read_table(spark, f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = id_remainder("doc_id", 4) == 2
    net = quality.fit(docs.where(~held_out), read_table(spark, f"{sf_dir}/labels.parquet").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.quality_score(spark, net).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector with its cluster, and its cluster's figures."""
    found = centroids.fit(read_table(spark, f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", dims=64, k=16, rounds=3, scale=64.0, seed=1)
    # A row a cluster: k bounds it.
    return (centroids.assignments(found).join(F.broadcast(centroids.summary(found)), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' records, written and read back."""
    pages = read_table(spark, f"{sf_dir}/pages.parquet")
    records = warc.read_warc(warc.write_warc(pages, "page_id", "url", "html"), payloads=False)
    return records.select(warc.id_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), warc.id_of(F.col("refers_to")).cast("long").alias("refers_to"))


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.summaries(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_fingerprints": op3_fingerprints,
    "op4_license_scan": op4_license_scan,
    "op5_decontaminate": op5_decontaminate,
    "op6_language_id": op6_language_id,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_lm_score": op8_lm_score,
    "op9_format_chats": op9_format_chats,
    "op10_quality": op10_quality,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_warc": op12_warc,
    "op13_align_tokenizers": op13_align_tokenizers,
}
