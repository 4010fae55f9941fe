"""

``prepare``: coerce and drop null times, dedup, fill, resample irregular series.
``fit`` / ``save`` / ``load`` / ``score``: fitted parameters as tables, and new rows scored with them, frozen.
``fit_score``: split, scale on train, detectors, error table, normalisers on val, ensemble score,
threshold on val, flags. Returns every intermediate table so queries and tests can look at each stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.operators import clean, ensemble, features, grid, learned, recon, split, windows
from seriesguard.plans import layout
from seriesguard.session import materialize
from seriesguard.sources import files


def prepare(df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str = "ts",
            tiebreak: Sequence[str] = (), fill: bool | str = True, resample: bool = True,
            keep_leading: bool = False, checkpoint: bool = True, raw_order: bool = False) -> DataFrame:
    """Clean one panel; the row index is computed once and shared by fill, deltas and resampling.

    ``fill`` is True (forward, then backward), ``"time"`` (linear in time) or False. ``raw_order`` leaves
    the rows as they are: no dedup, fill or resampling, only the columns chosen and null times dropped (X10).
    A series whose grid would be out of proportion to its rows (X14) keeps its rows, not resampled.

    One small aggregate measures the largest series; that bound picks every plan below (single window
    per series, or segments and blocks for huge series) without further jobs. The result is
    materialised (a table in the shared checkpoint folder): every later step reads it, and cutting the
    lineage here keeps plans small and recovery cheap. Huge series also materialise the row index,
    because the skew-safe plans read it several times.
    """
    stage = materialize if checkpoint else (lambda d, name=None: d)
    if fill not in (True, False, "time"):
        raise ValueError(f"unknown fill: {fill}")
    df = clean.drop_null_ts(df, ts)
    if raw_order:
        return stage(df.select(*keys, ts, *tiebreak, *cols), "prepared")
    df = clean.dedup_first(df.select(*keys, ts, *tiebreak, *cols), keys, ts, tiebreak)
    n_max = layout.max_series_rows(df, keys)
    big = n_max > layout.ROWS_PER_SEGMENT
    df = layout.row_index(df.select(*keys, ts, *cols), keys, ts, count_col=None, max_rows=n_max)
    if big:
        df = stage(df, "indexed")
    if fill:
        filled = clean.interpolate_time if fill == "time" else clean.fill_missing
        df = filled(df, keys, cols, ts, max_rows=n_max)
        if big and resample:
            df = stage(df, "filled")
    if resample:
        df = grid.resample_ffill(df, keys, cols, ts, keep_leading=keep_leading, max_rows=n_max, keep_large=True)
    return stage(df.select(*keys, ts, *cols), "prepared")


#: Stands for a phase that was given as a column and can't be saved.
OWN_PHASE = "?"


def _phase(phase: Column | str | None) -> Column | None:
    return F.expr(phase) if isinstance(phase, str) else phase


def _learned_errors(rows: DataFrame, models: Mapping[str, learned.Model], keys: Sequence[str], cols: Sequence[str], W: int, step: int, ts: str,
                    n_max: int | None) -> DataFrame:
    """Error rows of learned models over the windows of scaled rows."""
    flat = learned.flat_windows(windows.sliding_windows(rows, keys, cols, W, step, ts, max_rows=n_max))
    out = None
    for name, model in sorted(models.items()):
        errs = learned.error_rows(learned.model_errors(flat, model), keys, name, ts).where(F.col("err").isNotNull() & ~F.isnan("err"))
        out = errs if out is None else out.unionByName(errs)
    return out


@dataclass
class Params:
    """What scoring needs, as tables: scaler, phase means, normalisers, thresholds and learned models, and the options."""

    scaler: DataFrame
    means: DataFrame | None
    normalizers: DataFrame | None
    thresholds: DataFrame
    info: dict
    learned: Mapping[str, learned.Model] | None = None

    def save(self, path: str) -> None:
        """Writes the tables and the options (one JSON row) under ``path``."""
        for name in ("scaler", "means", "normalizers", "thresholds"):
            table = getattr(self, name)
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}/{name}")
        if self.learned:
            learned.models_table(self.scaler.sparkSession, self.learned).write.mode("overwrite").parquet(f"{path}/learned")
        files.save_record(self.scaler.sparkSession, self.info, f"{path}/info")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Params:
        info = files.load_record(spark, f"{path}/info")
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        return cls(read("scaler"), read("means") if "seasonal" in info["models"] else None,
                   read("normalizers") if info["normalization"] == "zscore" else None, read("thresholds"), info,
                   learned.load_models(read("learned")) if info.get("learned") else None)

    def phase(self, given: Column | str | None = None) -> Column | None:
        """H1's phase as it was fitted: the saved SQL text, or what the caller passes."""
        text = self.info.get("phase")
        if given is None and text == OWN_PHASE:
            raise ValueError("the fit has a phase of its own that was given as a column: pass it again, or fit with SQL text")
        return _phase(text if given is None else given)


@dataclass
class Fitted:
    split: DataFrame
    scaler: DataFrame
    scaled: DataFrame
    errors: DataFrame
    normalizers: DataFrame | None
    scores: DataFrame
    thresholds: DataFrame
    flagged: DataFrame
    n_max: int | None = None  # rows of the largest series: bounds every per-series group downstream
    means: DataFrame | None = None
    info: dict | None = None
    learned: Mapping[str, learned.Model] | None = None

    @property
    def params(self) -> Params:
        return Params(self.scaler, self.means, self.normalizers, self.thresholds, self.info, self.learned)


def fit_score(panel: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
              models: Sequence[str] = recon.MODELS, normalization: str = "zscore",
              method: str = "quantile", q: float = ensemble.DEFAULT_Q, k: float = ensemble.DEFAULT_K,
              ts: str = "ts", phase: Column | str | None = None, pooled: bool = False,
              val_ratio: float = 0.2, test_ratio: float = 0.2, rows_per_block: int | None = None,
              checkpoint: bool = True, full_lags: bool = False, more_errors: DataFrame | None = None,
              weights: Sequence[float] = recon.EWMA_WEIGHTS, kernel: Sequence[float] = recon.LOCAL_KERNEL,
              learn: Mapping[str, dict] | None = None) -> Fitted:
    """Fits on the train and validation part of ``panel`` and scores all of it.

    ``phase`` (SQL text, such as ``"dayofweek(ts)"``, or a column; the text is saved), ``weights`` and ``kernel`` are options of H1-H3.
    ``learn`` names learned models, fitted here and saved with the parameters: ``{"lin": {"kind": "pca", "k": 4}}`` (``learned.fit_model``).

    ``more_errors`` are error rows of further models (``keys, split, ts, rn_split, model, err``, e.g. of H4-H6) that
    join the ensemble. The scaled rows, errors and scores are written once; everything else reads them."""
    extra = {"rows_per_block": rows_per_block} if rows_per_block else {}
    stage = materialize if checkpoint else (lambda d, name=None: d)
    n_max = layout.max_series_rows(panel, keys)
    sp = split.chrono_split(panel, keys, ts, val_ratio=val_ratio, test_ratio=test_ratio, max_rows=n_max)
    sp = stage(sp, "split")
    scaler = stage(features.scaler_fit(sp, keys, cols, pooled=pooled), "scaler")
    scaled = stage(features.scaler_apply(sp, scaler, keys, cols, pooled=pooled), "scaled")
    own_phase = _phase(phase)
    means = stage(recon.phase_means(scaled, keys, cols, own_phase, ts), "means") if "seasonal" in models else None
    errs = recon.detect(scaled, keys, cols, W, step, models, ts, own_phase, weights=weights, kernel=kernel, max_rows=n_max, means=means,
                        full_lags=full_lags, **extra)
    used = list(models)
    fitted = None
    if learn:
        flat = stage(learned.flat_windows(windows.sliding_windows(scaled, keys, cols, W, step, ts, max_rows=n_max)), "windows")
        fitted = {name: learned.fit_model(flat, **options) for name, options in learn.items()}
        errs = errs.unionByName(_learned_errors(scaled, fitted, keys, cols, W, step, ts, n_max).select(*errs.columns))
        used = None
    if more_errors is not None:
        errs = errs.unionByName(more_errors.select(*errs.columns))
        used = None
    errs = stage(errs, "errors")
    norms = stage(ensemble.normalizers_fit(errs, keys, pooled=pooled), "normalizers") if normalization == "zscore" else None
    scores = stage(ensemble.ensemble(errs, keys, normalization, norms, used, pooled=pooled, ts=ts), "scores")
    thr = stage(ensemble.threshold_fit(scores, keys, method, q, k, pooled=pooled, max_group=n_max), "thresholds")
    flagged = stage(ensemble.flags(scores, thr, keys, pooled=pooled), "flagged")
    info = {"window_size": W, "step_size": step, "feature_order": list(cols), "timestamp_col": ts, "keys": list(keys),
            "models": list(models), "normalization": normalization, "threshold_method": method, "q": q, "k": k,
            "pooled": pooled, "full_lags": full_lags, "phase": phase if phase is None or isinstance(phase, str) else OWN_PHASE,
            "weights": list(weights), "kernel": list(kernel), "learned": {name: m.version for name, m in sorted((fitted or {}).items())}}
    return Fitted(sp, scaler, scaled, errs, norms, scores, thr, flagged, n_max, means, info, fitted)


def score(new: DataFrame, params: Params, phase: Column | str | None = None, tiebreak: Sequence[str] = (), raw_order: bool = False,
          more_errors: DataFrame | None = None) -> DataFrame:
    """Scores new rows with frozen parameters: every window of ``window_size`` rows of each series, without any split.

    Required columns are checked against the contract; rows with a null time are dropped. Rows are ordered by time and
    ``tiebreak`` and repeated times keep their first row (``raw_order`` keeps all rows, ordered by ``tiebreak`` as given).
    Series unknown to ``params`` are scored as far as pooled parameters go and else have status ``no_validation``.
    ``more_errors`` holds further models' errors of the same rows.
    """
    info = params.info
    keys, cols, ts = info["keys"], info["feature_order"], info["timestamp_col"]
    missing = [c for c in [*keys, ts, *cols] if c not in new.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    rows = new.select(*keys, ts, *tiebreak, *[F.col(c).cast("double").alias(c) for c in cols])
    if raw_order:
        if not tiebreak:
            raise ValueError("raw_order needs the columns that give the order in tiebreak")
        n_max = layout.max_series_rows(rows, keys)
        rows = layout.row_index(rows, keys, tiebreak[0], tiebreak[1:], count_col=None, max_rows=n_max)
    else:
        rows = clean.dedup_first(clean.drop_null_ts(rows, ts), keys, ts, tiebreak)
        n_max = layout.max_series_rows(rows, keys)
        rows = layout.row_index(rows, keys, ts, tiebreak, count_col=None, max_rows=n_max)
    rows = rows.withColumn("split", F.lit("new")).withColumn("rn_split", F.col("rn"))
    scaled = features.scaler_apply(rows, params.scaler, keys, cols, pooled=info["pooled"])
    W, step = info["window_size"], info["step_size"]
    errs = recon.detect(scaled, keys, cols, W, step, info["models"], ts, params.phase(phase), weights=info.get("weights", recon.EWMA_WEIGHTS),
                        kernel=info.get("kernel", recon.LOCAL_KERNEL), max_rows=n_max, means=params.means, full_lags=info["full_lags"])
    if params.learned:
        errs = errs.unionByName(_learned_errors(scaled, params.learned, keys, cols, W, step, ts, n_max).select(*errs.columns))
    if more_errors is not None:
        errs = errs.unionByName(more_errors.select(*errs.columns))
    scores = ensemble.ensemble(errs, keys, info["normalization"], params.normalizers, None, info["pooled"], ts)
    return ensemble.flags(scores, params.thresholds, keys, info["pooled"])
