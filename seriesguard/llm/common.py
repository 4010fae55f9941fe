"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a trim set and as a character class.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def hash128(*cols: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes; together wide enough to stand for the value."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit("b"), *cols)]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the input doesn't use (compared without case, as Spark resolves names)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
