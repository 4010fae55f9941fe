"""Chronological train / validation / test split per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.plans import layout as L

SPLITS = ("train", "val", "test")


def chrono_split(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
                 val_ratio: float = 0.2, test_ratio: float = 0.2,
                 rows_per_segment: int = L.ROWS_PER_SEGMENT, max_rows: int | None = None) -> DataFrame:
    """``n_test = int(n * test)``, ``n_val = int((n - n_test) * val)``; test is the tail.

    Adds ``rn`` (row index in the series), ``n_rows``, ``split`` and ``rn_split`` (index inside the split).
    """
    if "rn" not in df.columns:
        df = L.row_index(df, keys, ts, tiebreak, rows_per_segment=rows_per_segment, max_rows=max_rows)
    n = F.col("n_rows")
    n_test = F.floor(n.cast("double") * F.lit(float(test_ratio)))
    n_tv = n - n_test
    n_val = F.floor(n_tv.cast("double") * F.lit(float(val_ratio)))
    n_train = n_tv - n_val
    split = (F.when(F.col("rn") < n_train, F.lit("train"))
             .when(F.col("rn") < n_tv, F.lit("val")).otherwise(F.lit("test")))
    start = (F.when(F.col("rn") < n_train, F.lit(0))
             .when(F.col("rn") < n_tv, n_train).otherwise(n_tv))
    return df.withColumn("split", split).withColumn("rn_split", (F.col("rn") - start).cast("long"))


def split_bounds(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """First and last time and size of every split (the time index stays in the rows)."""
    return (df.groupBy(*keys, "split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max")))
