"""File sources and sinks (CSV/Parquet/JSON), all through ``spark.read`` / ``df.write``."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_series(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None,
                **options) -> DataFrame:
    """A1: a CSV (header, schema inferred unless given) or Parquet/JSON table."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_prefix(spark: SparkSession, root: str, suffix: str = ".csv", fmt: str = "csv",
                schema: T.StructType | str | None = None, key: str = "series_key") -> DataFrame:
    """A2: every file under ``root`` whose name ends with ``suffix``, one series per file.

    The file listing is done by the scan (``recursiveFileLookup`` + ``pathGlobFilter``), not by a
    driver loop; the series key is the file path from ``_metadata``.
    """
    reader = (spark.read.format(fmt).option("recursiveFileLookup", True)
              .option("pathGlobFilter", f"*{suffix}"))
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(root)
    return df.withColumn(key, F.col("_metadata.file_path"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "append") -> None:
    """Predictions, live metrics and window/feature stores as partitioned tables."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_record(spark: SparkSession, record: dict, path: str) -> None:
    """A contract or meta record as a one-row JSON table."""
    spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").write.mode(
        "overwrite").text(path)


def load_record(spark: SparkSession, path: str) -> dict:
    """Parameters are small by construction (one row), so reading them to the driver is bounded."""
    rows = spark.read.text(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one record in {path}, found {len(rows)}")
    return json.loads(rows[0][0])
