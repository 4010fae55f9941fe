"""The registered queries of the training-data operators and the SQL that DuckDB runs for them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, html_text, jaccard, langid, linededup, mixing, oracle, phrases, quality, simhash, suffixes, topk, whitening
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.temperature_shares(docs, alpha=0.5, total=200), block_docs=32)
    return mixed.select("doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("source_stream"),
                        "mix_block", "mix_slot", "mix_position")


def op2_va_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(50)) == 0, k=5)


def op3_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"), n_words=3, pct=90)


def op5_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.classify(docs, table(spark, sf_dir, "labels"), slim=True)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = linededup.dedup_lines(docs, min_chars=40, min_docs=5)
    return cut.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang"), sample_docs=400)
    texts = docs.select("doc_id", langid.is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.identify(texts, model, drop_text=True)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"), min_count=10, inside_pct=50, top=2000)


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # fixed values of the contract: one more conversation that holds control strings
    more = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    return chat.read_back(turns.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)


QUERIES = {"op1_mix_sources": op1_mix_sources, "op2_va_topk": op2_va_topk, "op3_site_templates": op3_site_templates,
           "op4_jaccard_join": op4_jaccard_join, "op5_quality_kneser_ney": op5_quality_kneser_ney, "op6_suffix_dedup": op6_suffix_dedup,
           "op7_line_dedup": op7_line_dedup,
           "op8_simhash": op8_simhash, "op9_ppm_language": op9_ppm_language, "op10_byte_bpe": op10_byte_bpe, "op11_phrases": op11_phrases, "op12_chat": op12_chat,
           "op13_whitening": op13_whitening}
ORACLE = {"op1_mix_sources": oracle.OP1, "op2_va_topk": oracle.OP2, "op4_jaccard_join": oracle.OP4, "op7_line_dedup": oracle.OP7,
          "op11_phrases": oracle.OP11, "op12_chat": oracle.OP12}
