"""From raw documents to a tokenised mixture: quality, line dedup, near-duplicate removal, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a DataFrame with the
columns of ``documents``; from the mixing stage on there is ``mix_position`` as well.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.llm import bpe, jaccard, linededup, mixing, quality
from seriesguard.session import configure, materialize, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Ids of removed documents are broadcast up to this many (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _columns(df: DataFrame) -> list[str]:
    return [*COLUMNS, *(c for c in df.columns if c not in COLUMNS)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; the model is trained on the trusted ones among ``docs``."""
    configure(spark)
    judged = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where("keep").select(*_columns(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of at least 40 characters that 5 documents or more share, except in one."""
    configure(spark)
    cut = linededup.dedup_lines(docs, min_chars=40, min_docs=5)
    changed = F.col("n_dropped") > 0
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return cut.select(*(n_chars if c == "n_chars" else F.col(c) for c in _columns(docs)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group whose sets of 5-word shingles are linked at a Jaccard
    similarity of at least 0.8. Of rows with the same id the one with the smallest text stays; rows with a null id all stay."""
    configure(spark)
    found = materialize(jaccard.near_components(docs, n_words=5, pct=80), "components")
    removed = found.where("doc_id <> component_id").select(F.col("doc_id").alias("removed_id")).distinct()
    repeated = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id")).where("n > 1")
    repeated = materialize(repeated.select("doc_id", "component_id"), "repeated")
    removed = removed.unionByName(repeated.select(F.col("doc_id").alias("removed_id"))).distinct()
    kept = _without(docs, materialize(removed, "removed")).select(*_columns(docs))
    if repeated.isEmpty():
        return kept
    once = repeated.where("doc_id = component_id").select(F.col("doc_id").alias("of"))
    again = docs.join(once, F.col("doc_id") == F.col("of"), "left_semi")
    by_text = F.struct("text", "lang", "source", "n_chars")  # the same one whenever a task runs again
    again = again.groupBy("doc_id").agg(F.min_by(F.struct(*_columns(docs)), by_text).alias("row")).select("row.*")
    return kept.unionByName(again.select(*_columns(docs)))


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    gone = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    return docs.join(gone, F.col("doc_id") == F.col("removed_id"), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture (``mix_position``), files and rows ascending."""
    configure(spark)
    mixed = mixing.mix(docs, mixing.temperature_shares(docs, alpha=0.5, total=200), block_docs=32)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = mixed.repartitionByRange(n, "mix_position").sortWithinPartitions("mix_position")
    return ordered.select(*_columns(docs), "mix_position")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``mix_position``, ``n_tokens``, the ids (``ids_le``: 4 little-endian bytes each) and
    whether decoding them gives the text's bytes (``exact``)."""
    configure(spark)
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    kept = ["doc_id", "lang", "source", *(["mix_position"] if "mix_position" in docs.columns else [])]
    return coded.select(*kept, "n_tokens", "ids_le", exact.alias("exact"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

#: The quality model, near-duplicate groups and tokens aren't expressed in SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(out)
        docs = spark.read.parquet(out)
    return docs
