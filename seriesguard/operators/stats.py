"""Reference and live statistics, anomaly rate, meta record, histograms.

All statistics are aggregates (map-side combined); nothing is collected. Reference feature statistics
weight every training row by the number of windows that hold it (J3), in closed form, without exploding
windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.columns import q
from seriesguard.functions.quantiles import group_quantile, group_quantiles

VAR_FLOOR = 1e-12
HIST_BINS = 10


def error_stats(scores: DataFrame, keys: Sequence[str], split: str = "val", col: str = "score",
                max_group: int | None = None) -> DataFrame:
    """Median and 95th percentile (linear) of the scores of one split."""
    rows = scores.where(F.col("split") == split) if split else scores
    return group_quantiles(rows, keys, col, {"median": 0.5, "p95": 0.95}, max_group=max_group)


def error_by_model(errs: DataFrame, keys: Sequence[str], max_group: int | None = None) -> DataFrame:
    """Mean and p95 of every model's window errors per split."""
    by = list(keys) + ["model", "split"]
    mean = errs.groupBy(*by).agg(F.avg("err").alias("err_mean"))
    return mean.join(group_quantile(errs, by, "err", 0.95, out="err_p95", max_group=max_group), by)


def coverage_weight(i, T, W: int, step: int):
    """Number of windows (size ``W``, starts ``0, step, ...``) of a ``T``-row split holding row ``i``."""
    hi = F.floor(F.least(i, T - F.lit(W)) / F.lit(step))
    lo = F.ceil(F.greatest(F.lit(0), i - F.lit(W - 1)) / F.lit(step))
    return F.when(T >= W, F.greatest(F.lit(0), hi - lo + F.lit(1))).otherwise(F.lit(0)).cast("double")


def _weighted_rows(df: DataFrame, keys: Sequence[str], W: int, step: int, split: str) -> DataFrame:
    rows = df.where(F.col("split") == split)
    n = rows.groupBy(*keys).agg((F.max("rn_split") + 1).alias("_T"))
    return rows.join(n, list(keys)).withColumn("_w", coverage_weight(F.col("rn_split"), F.col("_T"), W, step))


def _sums(rows: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """J3 and J4 in one aggregate: weighted sums of every feature and its square, and the sum of weights."""
    x = lambda c: F.col(q(c)).cast("double")
    aggs = [a for i, c in enumerate(cols) for a in (F.sum(F.col("_w") * x(c)).alias(f"_sx{i}"), F.sum(F.col("_w") * x(c) * x(c)).alias(f"_sxx{i}"))]
    return rows.groupBy(*by).agg(F.sum("_w").alias("_sw"), *aggs).where(F.col("_sw") > 0)


def _spread(mean, square):
    return F.sqrt(F.greatest(square - mean * mean, F.lit(VAR_FLOOR)))


def reference_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
                    split: str = "train", pooled: bool = False) -> DataFrame:
    """J3 and J4 as one row per series (``pooled``: one row): ``features`` (feature, mean, std; by feature order), ``global_mean``, ``global_std``.

    Rows count once per window that holds them: ``std = sqrt(max(E[x^2] - mean^2, 1e-12))``."""
    rows = _weighted_rows(df, keys, W, step, split)
    keys = [] if pooled else keys
    sums = _sums(rows, keys, cols)
    sw = F.col("_sw")
    entries = []
    for i, c in enumerate(cols):
        mean = F.col(f"_sx{i}") / sw
        entries.append(F.struct(F.lit(c).alias("feature"), mean.alias("mean"), _spread(mean, F.col(f"_sxx{i}") / sw).alias("std")))
    total = sw * F.lit(float(len(cols)))
    mean = sum((F.col(f"_sx{i}") for i in range(1, len(cols))), F.col("_sx0")) / total
    square = sum((F.col(f"_sxx{i}") for i in range(1, len(cols))), F.col("_sxx0")) / total
    return sums.select(*keys, F.array(*entries).alias("features"), mean.alias("global_mean"), _spread(mean, square).alias("global_std"))


def live_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str], split: str | None = "test",
               by: Sequence[str] = ()) -> DataFrame:
    """J5 and J6 as one row per series (and ``by``): mean and population std over plain rows, per feature and over all
    values. The global variance is put together from the features' own, so nothing cancels."""
    rows = df.where(F.col("split") == split) if split else df
    x = lambda c: F.col(q(c)).cast("double")
    own = range(len(cols))
    agg = rows.groupBy(*keys, *by).agg(*[a for i, c in enumerate(cols) for a in (
        F.count(x(c)).alias(f"_n{i}"), F.avg(x(c)).alias(f"_m{i}"), F.stddev_pop(x(c)).alias(f"_s{i}"))])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("std")) for i, c in enumerate(cols)]
    part = lambda e, i: F.coalesce(e, F.lit(0.0))
    total = sum((F.col(f"_n{i}") for i in own), F.lit(0))
    mean = F.try_divide(sum((part(F.col(f"_n{i}") * F.col(f"_m{i}"), i) for i in own), F.lit(0.0)), total)
    agg = agg.withColumn("global_mean", mean)
    dev = lambda i: F.col(f"_m{i}") - F.col("global_mean")
    var = F.try_divide(sum((part(F.col(f"_n{i}") * (F.col(f"_s{i}") * F.col(f"_s{i}") + dev(i) * dev(i)), i) for i in own), F.lit(0.0)), total)
    return agg.select(*keys, *by, F.array(*entries).alias("features"), "global_mean", F.sqrt(var).alias("global_std"))


def _per_feature(stats: DataFrame, by: Sequence[str]) -> DataFrame:
    return stats.select(*by, F.explode("features").alias("_e")).select(*by, "_e.feature", "_e.mean", "_e.std")


def feature_stats_ref(df: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
                      split: str = "train") -> DataFrame:
    """Per-feature mean and std over windowed rows."""
    return _per_feature(reference_stats(df, keys, cols, W, step, split), keys)


def global_stats_ref(df: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
                     split: str = "train") -> DataFrame:
    """Mean and std over all windowed values (every feature of every covered row)."""
    return reference_stats(df, keys, cols, W, step, split).drop("features")


def feature_stats_live(df: DataFrame, keys: Sequence[str], cols: Sequence[str], split: str | None = "test",
                       by: Sequence[str] = ()) -> DataFrame:
    """Per-feature mean and population std over plain rows."""
    return _per_feature(live_stats(df, keys, cols, split, by), [*keys, *by])


def global_stats_live(df: DataFrame, keys: Sequence[str], cols: Sequence[str], split: str | None = "test",
                      by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std over every value of every feature."""
    return live_stats(df, keys, cols, split, by).drop("features")


def anomaly_rate(flagged: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
    """Mean of the flags per split, or of the labels when a label column is given."""
    val = F.coalesce(F.col(label).cast("double"), F.col("flag").cast("double")) if label else F.col("flag")
    return flagged.groupBy(*keys, "split").agg(F.avg(val).alias("anomaly_rate"))


def meta_record(fitted, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The ensemble meta record per series as one nested row (normalisers as a map, null without them); of a pooled fit
    one record for all series. Options come from the fit itself."""
    info = fitted.info
    pooled = info["pooled"]
    by = [] if pooled else list(keys)
    one = F.lit(1).alias("_one")  # the rows of a pooled fit, one each, meet on a constant
    joined = lambda a, b: a.join(b, by, "left") if by else a.select("*", one).join(b.select("*", one), "_one", "left").drop("_one")
    es = error_stats(fitted.scores, by, max_group=None if pooled else fitted.n_max)
    rate = anomaly_rate(fitted.flagged.where(F.col("split") == "val"), by).drop("split")
    ref = reference_stats(fitted.scaled, keys, cols, info["window_size"], info["step_size"], pooled=pooled)
    out = joined(joined(joined(fitted.thresholds, es), rate), ref)
    if fitted.normalizers is not None:
        norms = fitted.normalizers.groupBy(*by).agg(
            F.map_from_entries(F.collect_list(F.struct("model", F.struct("mean", "std")))).alias("normalizers"))
        out = joined(out, norms)
    else:
        out = out.withColumn("normalizers", F.lit(None).cast("map<string,struct<mean:double,std:double>>"))
    keys = by
    return out.select(
        *keys, F.lit(info["normalization"]).alias("normalization"), "normalizers", "threshold",
        F.lit(info["threshold_method"]).alias("threshold_method"),
        F.struct(F.lit(float(info["q"])).alias("q"), F.lit(float(info["k"])).alias("k")).alias("threshold_params"),
        F.struct("median", "p95").alias("error_stats"), F.col("anomaly_rate").alias("anomaly_rate_ref"),
        F.struct(F.transform("features", lambda e: e["mean"]).alias("mean"), F.transform("features", lambda e: e["std"]).alias("std"),
                 "global_mean", "global_std").alias("feature_stats"))


def hist_bin(x, lo, hi, bins: int = HIST_BINS):
    """Bin 1..``bins`` for ``lo <= x <= hi`` (the max goes to the last bin), 0 below, ``bins + 1`` above."""
    inner = F.least(F.lit(bins), F.floor((x - lo) / (hi - lo) * F.lit(float(bins))).cast("int") + F.lit(1))
    return (F.when(x < lo, F.lit(0)).when(x > hi, F.lit(bins + 1))
            .when(hi == lo, F.lit(1)).otherwise(inner)).cast("int")


def feature_histogram(df: DataFrame, keys: Sequence[str], cols: Sequence[str], bins: int = HIST_BINS,
                      fit_split: str = "train") -> DataFrame:
    """Fixed edges from the training min/max; every split is counted on the training edges."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(q(c)).cast("double").alias("x")) for c in cols])
    long = df.select(*keys, "split", F.explode(entries).alias("_e")).select(*keys, "split", "_e.feature", "_e.x")
    edges = (long.where(F.col("split") == fit_split).groupBy(*keys, "feature")
             .agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    j = long.where(F.col("x").isNotNull()).join(edges, list(keys) + ["feature"])
    return (j.groupBy(*keys, "feature", "split", hist_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
