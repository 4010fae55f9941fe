"""Series verdicts and routing, run logs, best step and best model, flag summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARSE_THRESHOLD = 0.8


def series_verdicts(df: DataFrame, keys: Sequence[str], ts: str, min_rows: int = 16) -> DataFrame:
    """Per series: valid when more than 80% of rows have a time and it has at least ``min_rows`` rows."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count(ts).alias("n_ts"))
    reason = (F.when(F.col("n_ts") / F.col("n_rows") <= PARSE_THRESHOLD, F.lit("time column unparsable"))
              .when(F.col("n_rows") < min_rows, F.lit(f"fewer than {min_rows} rows")))
    return agg.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def route(df: DataFrame, verdicts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A10: rows of valid series go on; rejected series are reported, and do not stop the others."""
    v = verdicts.select(*keys, "valid")
    valid = df.join(v.where(F.col("valid")), list(keys), "left_semi")
    rejected = verdicts.where(~F.col("valid"))
    return valid, rejected


def log_metrics(df: DataFrame, run_id: str, key_col: str, step_col: str, value_col: str) -> DataFrame:
    """A run log as append-only long rows ``(run_id, key, step, value)``."""
    return df.select(F.lit(run_id).alias("run_id"), F.col(key_col).alias("key"),
                     F.col(step_col).cast("int").alias("step"), F.col(value_col).cast("double").alias("value"))


def append_metrics(log: DataFrame, path: str) -> None:
    """Appends run log rows to the table at ``path``, one folder per run."""
    log.select("run_id", "key", "step", "value").write.mode("append").partitionBy("run_id").parquet(path)


def best_step(log: DataFrame) -> DataFrame:
    """Step with the lowest value per run and key; ties go to the earliest step."""
    rank = F.struct(F.col("value"), F.col("step"))
    return log.groupBy("run_id", "key").agg(F.min_by("step", rank).alias("best_step"),
                                            F.min("value").alias("best_value"))


def best_model(by_model: DataFrame, keys: Sequence[str], split: str = "val") -> DataFrame:
    """Model with the lowest mean error on the validation split per series (ties: name order)."""
    rows = by_model.where(F.col("split") == split)
    rank = F.struct(F.col("err_mean"), F.col("model"))
    return rows.groupBy(*keys).agg(F.min_by("model", rank).alias("best_model"), F.min("err_mean").alias("val_err"))


def flag_summary(flagged: DataFrame, keys: Sequence[str], series: DataFrame | None = None) -> DataFrame:
    """Flagged windows and the message the scoring call returns.

    ``n_flagged`` counts over judged windows (those with a flag) and is null if there is none. With ``series`` (rows with the keys) also
    series without any window have a row."""
    agg = flagged.groupBy(*keys).agg(F.sum("flag").cast("long").alias("n_flagged"), F.count(F.lit(1)).alias("n_windows"),
                                     F.count("flag").alias("_judged"))
    if series is not None:
        agg = series.select(*keys).distinct().join(agg, list(keys), "left").fillna(0, ["n_windows", "_judged"])
    msg = (F.when(F.col("n_windows") == 0, F.lit("Not enough rows for one window")).when(F.col("_judged") == 0, F.lit("No threshold to judge by"))
           .when(F.col("n_flagged") == 0, F.lit("No anomalies detected")).otherwise(F.lit("OK")))
    return agg.withColumn("message", msg).drop("_judged")
