"""H1-H3: reconstruction detectors as window functions over the block layout.

The reference trains three networks for long-term, mid-range and local structure. Their roles become:

* H1 ``seasonal``: the training mean of each phase (hour of day by default) reconstructs a row.
* H2 ``ewma``: a fixed weighted mean of the previous rows of the same split, renormalised over the rows that exist.
* H3 ``local``: neighbours inside the window, a 3-tap kernel renormalised at the window edges.

All three are computed in one pass over one layout (one shuffle, one sort): H1 and H2 give a row
error that is averaged over the ``W`` rows of a window; H3 depends on the window edges, and its error is
rebuilt from three per-row terms (left edge, interior, right edge), so no window array is materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.columns import q
from seriesguard.operators.windows import ensure_split, window_end
from seriesguard.plans import layout as L

# Fixed parameters of the re-aimed detectors (defaults; all are arguments).
EWMA_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
LOCAL_KERNEL = (0.25, 0.5, 0.25)
MODELS = ("seasonal", "ewma", "local")


def _mean_sq(diffs: list[Column]) -> Column:
    total = diffs[0] * diffs[0]
    for d in diffs[1:]:
        total = total + d * d
    return total / F.lit(float(len(diffs)))


def phase_means(df: DataFrame, keys: Sequence[str], cols: Sequence[str], phase: Column | None = None,
                ts: str = "ts", fit_split: str = "train") -> DataFrame:
    """H1 fit: mean of every feature per series and phase over the fit split."""
    phase = phase if phase is not None else F.hour(ts)
    rows = df.where(F.col("split") == fit_split) if "split" in df.columns else df
    return (rows.withColumn("_phase", phase)
            .groupBy(*keys, "_phase").agg(*[F.avg(q(c)).alias(f"seasonal__{c}") for c in cols]))


def recon_seasonal(df: DataFrame, keys: Sequence[str], cols: Sequence[str], phase: Column | None = None,
                   ts: str = "ts", fit_split: str = "train", means: DataFrame | None = None) -> DataFrame:
    """H1: adds ``seasonal__<c>`` (reconstruction) and ``rowerr__seasonal``; ``means`` are frozen phase means."""
    phase = phase if phase is not None else F.hour(ts)
    means = phase_means(df, keys, cols, phase, ts, fit_split) if means is None else means
    out = df.withColumn("_phase", phase).join(means, list(keys) + ["_phase"], "left").drop("_phase")
    return out.withColumn("rowerr__seasonal",
                          _mean_sq([F.col(q(c)) - F.col(q(f"seasonal__{c}")) for c in cols]))


def recon_ewma(laid: DataFrame, keys: Sequence[str], cols: Sequence[str],
               weights: Sequence[float] = EWMA_WEIGHTS, full_lags: bool = False) -> DataFrame:
    """H2: ``sum_k w_k x[t-k] / sum_k w_k`` over the previous rows ``k`` that exist in the split, so only the
    first row of a split has no reconstruction (with ``full_lags`` the first ``len(weights)`` rows). Needs a
    layout halo of ``len(weights)``."""
    w = L.seq_window(laid, keys)
    first = len(weights) if full_lags else 1
    exists = [F.col("rn_split") >= k for k in range(1, len(weights) + 1)]
    total = sum((F.when(e, F.lit(float(x))).otherwise(0.0) for e, x in zip(exists, weights, strict=True)), F.lit(0.0))
    out = laid
    for c in cols:
        terms = [F.when(e, F.lag(F.col(q(c)), k).over(w) * F.lit(float(x))).otherwise(0.0)
                 for k, (e, x) in enumerate(zip(exists, weights, strict=True), start=1)]
        out = out.withColumn(f"ewma__{c}", F.when(F.col("rn_split") >= first, sum(terms[1:], terms[0]) / total))
    return out.withColumn("rowerr__ewma", _mean_sq([F.col(q(c)) - F.col(q(f"ewma__{c}")) for c in cols]))


def local_terms(laid: DataFrame, keys: Sequence[str], cols: Sequence[str],
                kernel: Sequence[float] = LOCAL_KERNEL) -> DataFrame:
    """H3 per-row terms, all looking back: right-edge error of this row, and left-edge and interior
    errors of the previous row (which need this row as its right neighbour)."""
    kl, kc, kr = (float(x) for x in kernel)
    w = L.seq_window(laid, keys)
    x0 = {c: F.col(q(c)) for c in cols}
    x1 = {c: F.lag(F.col(q(c)), 1).over(w) for c in cols}
    x2 = {c: F.lag(F.col(q(c)), 2).over(w) for c in cols}
    right = _mean_sq([x0[c] - (F.lit(kl) * x1[c] + F.lit(kc) * x0[c]) / F.lit(kl + kc) for c in cols])
    left_prev = _mean_sq([x1[c] - (F.lit(kc) * x1[c] + F.lit(kr) * x0[c]) / F.lit(kc + kr) for c in cols])
    mid_prev = _mean_sq([x1[c] - (F.lit(kl) * x2[c] + F.lit(kc) * x1[c] + F.lit(kr) * x0[c])
                         / F.lit(kl + kc + kr) for c in cols])
    return (laid.withColumn("_h3_right", right).withColumn("_h3_left_prev", left_prev)
            .withColumn("_h3_mid_prev", mid_prev))


def window_errors(laid: DataFrame, keys: Sequence[str], W: int, step: int = 1,
                  models: Sequence[str] = MODELS, full_lags: bool = False) -> DataFrame:
    """I1 for the row detectors: mean squared error over the rows and ``C`` features of every window.

    A window with a row lacking a reconstruction has no error for that model. The exception is the first row
    of a split, which H2 has nothing to reconstruct from: the split's first window averages its other rows."""
    w = L.seq_window(laid, keys)
    frame = w.rowsBetween(-(W - 1), 0)
    out = laid
    for m in models:
        if m == "local":
            if W < 3:
                raise ValueError("the local detector needs W >= 3")
            inner = F.sum("_h3_mid_prev").over(w.rowsBetween(-(W - 3), 0))
            err = (F.lag("_h3_left_prev", W - 2).over(w) + inner + F.col("_h3_right")) / F.lit(float(W))
            whole = F.count("_h3_mid_prev").over(w.rowsBetween(-(W - 3), 0)) == W - 2
            out = out.withColumn("err__local", F.when(whole, err))
        else:
            rc = F.col(f"rowerr__{m}")
            needed = F.lit(W)
            if m == "ewma" and not full_lags and W > 1:
                needed = F.when(F.col("rn_split") == W - 1, W - 1).otherwise(W)
            out = out.withColumn(f"err__{m}", F.when(F.count(rc).over(frame) == needed, F.avg(rc).over(frame)))
    return out.where(window_end(W, step))


def errors_long(win: DataFrame, keys: Sequence[str], models: Sequence[str] = MODELS,
                ts: str = "ts") -> DataFrame:
    """Error table ``(keys, split, ts, rn_split, model, err)``; windows without an error are left out."""
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"err__{m}").alias("err")) for m in models])
    return (win.select(*keys, "split", ts, "rn_split", F.explode(entries).alias("_e"))
            .select(*keys, "split", ts, "rn_split", "_e.model", "_e.err")
            .where(F.col("err").isNotNull()))


def detect(df: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
           models: Sequence[str] = MODELS, ts: str = "ts", phase: Column | None = None,
           weights: Sequence[float] = EWMA_WEIGHTS, kernel: Sequence[float] = LOCAL_KERNEL,
           keep_rows: bool = False, rows_per_block: int = L.ROWS_PER_BLOCK,
           max_rows: int | None = None, means: DataFrame | None = None, full_lags: bool = False) -> DataFrame:
    """H1-H3 + I1 in one layout: returns the long error table (or the laid rows with ``keep_rows``).

    ``means`` are frozen phase means (``phase_means``); without them H1 is fitted on the ``train`` split."""
    models = list(models)
    unknown = set(models) - set(MODELS)
    if not models or unknown:
        raise ValueError(f"unknown or empty model set: {sorted(unknown) or models}")
    df = ensure_split(df, keys, ts)
    if "seasonal" in models:
        df = recon_seasonal(df, keys, cols, phase, ts, means=means)
    lookback = W - 1 + (len(weights) if "ewma" in models else 0) + 2
    laid = L.with_blocks(df, keys, lookback, rows_per_block=rows_per_block, max_rows=max_rows)
    if "ewma" in models:
        laid = recon_ewma(laid, keys, cols, weights, full_lags)
    if "local" in models:
        laid = local_terms(laid, keys, cols, kernel)
    if keep_rows:
        return laid  # still laid out (with halo rows): callers finish with ``layout.drop_halo``
    win = L.drop_halo(window_errors(laid, keys, W, step, models, full_lags))
    return errors_long(win, keys, models, ts)
