"""The registered queries of this package.

Each query applies one operator to its whole table and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    best_fit_packing,
    centroid_clustering,
    decontaminate,
    host_reputation,
    html_extract,
    line_dedup,
    oracles,
    quality_rules,
    secret_scan,
    sentencepiece_fst,
    simhash,
    source_divergence,
    tool_calls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans: Column) -> Column:
        place = lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )
        return F.array_join(F.transform(spans, place), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        sha256_of(joined(base)).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.matched(docs, table(spark, folder, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.inline("matches")).select(
        "doc_id",
        "item_id",
        "covered",
        "n_tokens",
        "n_tiles",
        (F.col("covered") / F.col("n_tokens")).alias("coverage"),
    )


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs, machine = table(spark, folder, "documents"), sentencepiece_fst.load(spark)
    encoded = sentencepiece_fst.encode_checked(docs, machine, carry=["doc_id"])
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_ids",
        sha256_of(F.array_join("ids", ",")).alias("ids_sha256"),
        "given_back",
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id"
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.deduplicate(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        sha256_of(F.col("kept")).alias("kept_sha256"),
    )


def op6_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extracted(table(spark, folder, "pages"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"), carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest, archives = warc.deduplicate(table(spark, folder, "pages"))
    return warc.read_archives(manifest, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.link(table(spark, folder, "conversations"))


def op10_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are labelled by the labels of their id; bad is toxic or of low quality."""
    bad = F.when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), F.lit(0))
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(1)).otherwise(bad)
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), bad.alias("bad")
    )
    return host_reputation.judge(table(spark, folder, "pages"), labels).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centroids = centroid_clustering.cluster(table(spark, folder, "embeddings"))
    return centroid_clustering.with_inertia(assigned, centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(table(spark, folder, "documents"))


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = best_fit_packing.pieces(table(spark, folder, "documents"))
    told = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return best_fit_packing.place(told).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_decontaminate": op2_decontaminate,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_simhash": op4_simhash,
        "op5_line_dedup": op5_line_dedup,
        "op6_html_extract": op6_html_extract,
        "op7_quality_rules": op7_quality_rules,
        "op8_warc": op8_warc,
        "op9_tool_calls": op9_tool_calls,
        "op10_host_reputation": op10_host_reputation,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_source_divergence": op12_source_divergence,
        "op13_best_fit_packing": op13_best_fit_packing,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.build()
