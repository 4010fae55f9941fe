"""Scaling, one-hot encoding, assembly and the frozen feature contract.

Fitted parameters are one small row per series (or one row when ``pooled``); they are joined back by
key and Spark broadcasts them when their measured size is under the broadcast threshold.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.functions.columns import q

# sklearn StandardScaler treats a scale below 10 * float64 eps as zero variance and uses 1.
ZERO_SCALE = 10 * 2.220446049250313e-16


def _one_row_join(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach a one-row parameter table (pooled fit) to every row: a broadcast equi-join on a constant."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(params.withColumn("_one", F.lit(1))), "_one", "left").drop("_one"))


def _fit_rows(df: DataFrame, split_col: str | None, fit_split: str | None) -> DataFrame:
    if split_col and fit_split and split_col in df.columns:
        return df.where(F.col(split_col) == fit_split)
    return df


def scaler_fit(df: DataFrame, keys: Sequence[str], cols: Sequence[str], split_col: str = "split",
               fit_split: str = "train", pooled: bool = False) -> DataFrame:
    """mean and population std per feature on the fit rows; zero variance gets scale 1."""
    rows = _fit_rows(df, split_col, fit_split)
    aggs = []
    for c in cols:
        aggs += [F.avg(q(c)).alias(f"mean__{c}"), F.stddev_pop(q(c)).alias(f"std__{c}")]
    fit = rows.agg(*aggs) if pooled else rows.groupBy(*keys).agg(*aggs)
    for c in cols:
        s = F.col(q(f"std__{c}"))
        fit = fit.withColumn(f"scale__{c}", F.when(s.isNull() | (s < ZERO_SCALE), F.lit(1.0)).otherwise(s))
    return fit


def scaler_long(fit: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Scaler parameters as ``(keys, feature, mean, std, scale)`` rows."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(q(f"mean__{c}")).alias("mean"),
                        F.col(q(f"std__{c}")).alias("std"), F.col(q(f"scale__{c}")).alias("scale"))
               for c in cols]
    return fit.select(*keys, F.explode(F.array(*entries)).alias("_p")).select(*keys, "_p.*")


def scaler_apply(df: DataFrame, fit: DataFrame | None, keys: Sequence[str], cols: Sequence[str],
                 pooled: bool = False) -> DataFrame:
    """``(x - mean) / scale``; without a fitted scaler the raw values pass (as the reference)."""
    if fit is None:
        return df.select(*[F.col(q(c)).cast("double").alias(c) if c in cols else F.col(q(c))
                           for c in df.columns])
    joined = _one_row_join(df, fit) if pooled else df.join(fit, list(keys), "left")
    out = joined
    for c in cols:
        out = out.withColumn(c, (F.col(q(c)).cast("double") - F.col(q(f"mean__{c}"))) / F.col(q(f"scale__{c}")))
    return out.select(*df.columns)


def onehot_fit(df: DataFrame, keys: Sequence[str], cols: Sequence[str], split_col: str = "split",
               fit_split: str = "train", pooled: bool = True) -> DataFrame:
    """the categories seen in the fit rows, one row each: ``column``, ``category`` and ``pos`` (0-based, in the
    categories' order). Any number of categories: they are made distinct by a shuffle and numbered like rows."""
    from seriesguard.plans import layout

    rows = _fit_rows(df, split_col, fit_split)
    by = [] if pooled else list(keys)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("string").alias("category")) for c in cols])
    long = rows.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*").where(F.col("category").isNotNull()).distinct()
    return layout.row_index(long, [*by, "column"], "category", out="pos", count_col=None).select(*by, "column", "category", "pos")


def onehot_apply(df: DataFrame, fit: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 pooled: bool = True) -> DataFrame:
    """``<c>__pos`` (position of the category, null if unknown or null) and ``<c>__size`` (number of categories)
    for every categorical column, by an equi-join on the value. ``assemble`` turns them into a vector."""
    by = [] if pooled else list(keys)
    out = df
    for c in cols:
        own = fit.where(F.col("column") == c)
        out = out.join(own.select(*by, F.col("category").alias(c), F.col("pos").alias(f"{c}__pos")), [*by, c], "left")
        size = own.groupBy(*by).agg(F.count(F.lit(1)).alias(f"{c}__size"))
        out = _one_row_join(out, size) if pooled else out.join(size, by, "left")
        out = out.withColumn(f"{c}__size", F.coalesce(F.col(f"{c}__size"), F.lit(0)))
    return out.select(*df.columns, *[f"{c}__{x}" for c in cols for x in ("pos", "size")])


def assemble(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
             out: str = "features") -> DataFrame:
    """numeric features first, then the one-hot blocks, as a sparse vector ``struct<size, indices, values>`` with every
    numeric feature and the ones; other columns are not part of it. ``dense`` gives the array."""
    n = len(numeric)
    indices = [F.lit(i).cast("long") for i in range(n)]
    values = [F.col(q(c)).cast("double") for c in numeric]
    start = F.lit(n).cast("long")
    for c in categorical:
        indices.append(start + F.col(q(f"{c}__pos")))
        values.append(F.lit(1.0))
        start = start + F.col(q(f"{c}__size"))
    pairs = F.array(*[F.struct(i.alias("i"), v.alias("v")) for i, v in zip(indices, values, strict=True)])
    known = F.filter(pairs, lambda p: p["i"].isNotNull())
    return df.withColumn(out, F.struct(start.alias("size"), F.transform(known, lambda p: p["i"]).alias("indices"),
                                       F.transform(known, lambda p: p["v"]).alias("values")))


def dense(vector: str):
    """The dense array of a sparse vector (for small sizes: it holds ``size`` numbers)."""
    v = F.col(vector)
    entries = F.map_from_arrays(v["indices"], v["values"])
    return F.transform(F.sequence(F.lit(0).cast("long"), v["size"] - 1), lambda i: F.coalesce(F.element_at(entries, i), F.lit(0.0)))


def contract(spark: SparkSession, window_size: int, step_size: int, feature_order: Sequence[str],
             timestamp_col: str, encoded_width: int | None = None) -> DataFrame:
    """the frozen window/feature contract as a one-row table with a schema hash."""
    body = {"window_size": int(window_size), "step_size": int(step_size),
            "feature_order": list(feature_order), "timestamp_col": timestamp_col,
            "encoded_width": int(encoded_width if encoded_width is not None else len(feature_order))}
    digest = hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()[:16]
    return spark.createDataFrame([(body["window_size"], body["step_size"], body["feature_order"],
                                   body["timestamp_col"], body["encoded_width"], digest)],
                                 "window_size int, step_size int, feature_order array<string>, "
                                 "timestamp_col string, encoded_width int, schema_hash string")


def name_columns(df: DataFrame, feature_order: Sequence[str], ts: str) -> DataFrame:
    """Names for a bare matrix, the time column first; the number of columns must fit the contract."""
    names = [ts, *feature_order]
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns for {len(names)} names")
    return df.toDF(*names)


def enforce_contract(df: DataFrame, feature_order: Sequence[str], ts: str) -> DataFrame:
    """Required columns present (checked at plan time), ordered and cast to double."""
    missing = [c for c in [ts, *feature_order] if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(F.col(q(ts)), *[F.col(q(c)).cast("double").alias(c) for c in feature_order])
