"""The operators over the given tables, one query each, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import (alignment, html, mixing, negatives, packing, planes, quality, search, simhash, substrings,
                           suffixes, urls, warc)
from matchlake.llm.oracle import ORACLE as ORACLE  # noqa: PLC0414
from matchlake.operators.common import scratch_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_rules(spark, sf):
    return quality.judge(table(spark, sf, "documents"))


def op2_url_filters(spark, sf):
    return urls.judge(table(spark, sf, "pages"))


def op3_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


def op4_simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op5_source_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


def op6_warc(spark, sf):
    index = warc.write(table(spark, sf, "pages"), scratch_dir(spark, "warc"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_substring_dedup(spark, sf):
    return substrings.dedup(table(spark, sf, "documents")).drop("kept")


def op8_html_extraction(spark, sf):
    return html.extract(table(spark, sf, "pages"))


def op9_suffix_array_dedup(spark, sf):
    return suffixes.dedup(table(spark, sf, "documents")).drop("kept")


def op10_exact_topk(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return search.search(rows, rows.filter("id % 50 = 0"))


def op11_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("v"))
    return negatives.mine(rows, F.col("id") % 50 == 0)


def op12_cross_tokenizer_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"))


def op13_token_planes(spark, sf):
    index = planes.write(table(spark, sf, "documents"), scratch_dir(spark, "planes"))
    return planes.read(index).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_url_filters, op3_best_fit_packing,
                                   op4_simhash_near_dedup, op5_source_mixing, op6_warc, op7_substring_dedup,
                                   op8_html_extraction, op9_suffix_array_dedup, op10_exact_topk,
                                   op11_hard_negatives, op12_cross_tokenizer_alignment, op13_token_planes)}
