"""Window and timestep errors, ensemble score, threshold and flags.

Fitted parameters (normalisers, thresholds) are per series by default; ``pooled=True`` fits one set
over all series. Their tables have one row per series (and model) and are joined back by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.quantiles import group_quantile

NORMALIZATIONS = ("none", "zscore")
THRESHOLD_METHODS = ("quantile", "std")
# Fixed values of the reference: quantile 0.99, k = 3 (defect X6 fixed), std offset 1e-12.
DEFAULT_Q = 0.99
DEFAULT_K = 3.0
STD_EPS = 1e-12


def _one_row_join(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach a one-row parameter table (pooled fit) to every row: a broadcast equi-join on a constant."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(params.withColumn("_one", F.lit(1))), "_one", "left").drop("_one"))


def _by(keys: Sequence[str], pooled: bool) -> list[str]:
    return [] if pooled else list(keys)


def _join(df: DataFrame, params: DataFrame, on: list[str]) -> DataFrame:
    # With no key the parameter table has exactly one row (per model): a proven size bound.
    return df.join(F.broadcast(params) if not [k for k in on if k != "model"] else params, on, "left")


def normalizers_fit(errs: DataFrame, keys: Sequence[str], fit_split: str = "val",
                    pooled: bool = False) -> DataFrame:
    """I4: per model mean and population std + 1e-12 of the errors on the fit split."""
    by = _by(keys, pooled) + ["model"]
    return (errs.where(F.col("split") == fit_split).groupBy(*by)
            .agg(F.avg("err").alias("mean"), (F.stddev_pop("err") + F.lit(STD_EPS)).alias("std")))


def ensemble(errs: DataFrame, keys: Sequence[str], normalization: str = "zscore",
             normalizers: DataFrame | None = None, models: Sequence[str] | None = None,
             pooled: bool = False, ts: str = "ts") -> DataFrame:
    """Mean over the models that scored a window of its (z-normalised) errors.

    Every window with any error has a row; ``n_models`` counts the models behind its score. Without normalisers
    for a series (no validation windows) its scores are null."""
    if normalization not in NORMALIZATIONS:
        raise ValueError(f"Unknown normalization: {normalization}")
    if models is not None and len(models) == 0:
        raise ValueError("the model set is empty")
    e = errs if models is None else errs.where(F.col("model").isin(list(models)))
    if normalization == "zscore":
        if normalizers is None:
            raise ValueError("normalization='zscore' requires normalizers")
        on = _by(keys, pooled) + ["model"]
        e = _join(e, normalizers.select(*on, "mean", "std"), on)
        z = (F.col("err") - F.col("mean")) / F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0))
        e = e.withColumn("err", z)
    return e.groupBy(*keys, "split", ts, "rn_split").agg(F.avg("err").alias("score"), F.count("err").alias("n_models"))


def threshold_fit(scores: DataFrame, keys: Sequence[str], method: str = "quantile", q: float = DEFAULT_Q,
                  k: float = DEFAULT_K, fit_split: str = "val", pooled: bool = False,
                  max_group: int | None = None) -> DataFrame:
    """Exact quantile of the fit-split scores, or mean + k * population std."""
    if method not in THRESHOLD_METHODS:
        raise ValueError(f"Unknown threshold method: {method}")
    rows = scores.where(F.col("split") == fit_split)
    by = _by(keys, pooled)
    if method == "quantile":
        return group_quantile(rows, by, "score", q, out="threshold", max_group=None if pooled else max_group)
    agg = (F.avg("score") + F.lit(float(k)) * F.stddev_pop("score")).alias("threshold")
    return rows.groupBy(*by).agg(agg) if by else rows.agg(agg)


def flags(scores: DataFrame, thresholds: DataFrame, keys: Sequence[str], pooled: bool = False) -> DataFrame:
    """I8: ``flag = score > threshold`` (strict), on unrounded values. A series without validation windows has no
    threshold: its rows stay, with a null flag and status ``no_validation``."""
    by = _by(keys, pooled)
    j = _one_row_join(scores, thresholds) if not by else scores.join(thresholds, by, "left")
    known = F.col("score").isNotNull() & F.col("threshold").isNotNull()
    return (j.withColumn("flag", F.when(known, (F.col("score") > F.col("threshold")).cast("int")))
            .withColumn("status", F.when(known, F.lit("ok")).otherwise(F.lit("no_validation"))))


def results_table(flagged: DataFrame, keys: Sequence[str], ts: str = "ts", split: str | None = "test") -> DataFrame:
    """Time, ensemble error and flag (the time label is carried, defect X2 fixed)."""
    rows = flagged.where(F.col("split") == split) if split else flagged
    return rows.select(*keys, F.col(ts).alias("timestamp"), F.col("score").alias("ensemble_error"), "flag")


def err_timesteps(laid_rows: DataFrame, keys: Sequence[str], model: str, W: int, step: int = 1,
                  ts: str = "ts") -> DataFrame:
    """Per-timestep error (mean over features) of every window, long form ``(window, pos, err)``.

    Errors of H1 and H2 don't depend on the window, so each position is a lag of the row error at the window
    end. H3 depends on the window's edges: the first position takes the left-edge term, the last one the
    right-edge term. Positions without a reconstruction (the first row of a split under H2) have no row.
    """
    from seriesguard.operators.windows import window_end
    from seriesguard.plans import layout as L

    w = L.seq_window(laid_rows, keys)

    def back(name: str, k: int):
        return F.lag(F.col(name), k).over(w) if k else F.col(name)

    if model == "local":  # edge terms of a row stand at the row after it
        at = [back("_h3_left_prev", W - 2), *(back("_h3_mid_prev", W - 2 - p) for p in range(1, W - 1)), F.col("_h3_right")]
    else:
        at = [back(f"rowerr__{model}", W - 1 - p) for p in range(W)]
    win = L.drop_halo(laid_rows.withColumn("_errs", F.array(*at)).where(window_end(W, step)))
    return (win.select(*keys, "split", F.col(ts).alias("win_end_ts"), F.posexplode("_errs").alias("pos", "err"))
            .where(F.col("err").isNotNull()))


def err_timesteps_arrays(windows: DataFrame, keys: Sequence[str], win: str = "win", recon: str = "recon",
                         ts: str = "ts") -> DataFrame:
    """I2 for models that return window arrays: ``win`` and ``recon`` are (W, C) arrays of one window."""
    errs = F.zip_with(win, recon, lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                                                          lambda s, d: s + d) / F.size(a))
    return windows.select(*keys, "split", F.col(ts).alias("win_end_ts"), F.posexplode(errs).alias("pos", "err"))
