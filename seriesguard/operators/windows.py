"""Sliding row windows per series and split.

A window of ``W`` rows is labelled by its last row (G2). Starts are ``0, step, 2*step, ...`` inside the
split, so a window ends at ``rn_split = W - 1 + k * step`` and never crosses a split. Windows are built
on the block layout with a halo of ``W - 1`` rows, so a huge series is cut into blocks (G5) and every
block gives the same windows as the whole series.

Window arrays are ``W`` times the data; detectors that reconstruct rows (H1, H2, H3) never build them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.columns import q
from seriesguard.plans import layout as L


def ensure_split(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Treat a frame with no ``split`` column as one split (index = row index)."""
    if "rn" not in df.columns:
        df = L.row_index(df, keys, ts, tiebreak)
    if "split" not in df.columns:
        df = df.withColumn("split", F.lit("all"))
    if "rn_split" not in df.columns:
        df = df.withColumn("rn_split", F.col("rn"))
    return df


def window_end(W: int, step: int, extra_lookback: int = 0) -> Column:
    """True on the last row of a full window that starts at a multiple of ``step`` (and at or after
    ``extra_lookback``, for detectors that need earlier rows of the split)."""
    first_end = W - 1 + extra_lookback
    pos = F.col("rn_split") - F.lit(W - 1)
    aligned = (pos % F.lit(step)) == 0 if step > 1 else F.lit(True)
    return (F.col("rn_split") >= F.lit(first_end)) & aligned


def sliding_windows(df: DataFrame, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1,
                    ts: str = "ts", tiebreak: Sequence[str] = (), out: str = "win",
                    rows_per_block: int = L.ROWS_PER_BLOCK, max_rows: int | None = None) -> DataFrame:
    """One row per window, ``win`` is ``array<array<double>>`` of shape ``(W, C)``."""
    if W < 1 or step < 1:
        raise ValueError("window size and step must be positive")
    df = ensure_split(df, keys, ts, tiebreak)
    laid = L.with_blocks(df, keys, W - 1, rows_per_block=rows_per_block, max_rows=max_rows)
    frame = L.seq_window(laid, keys).rowsBetween(-(W - 1), 0)
    row = F.array(*[F.col(q(c)).cast("double") for c in cols])
    laid = laid.withColumn(out, F.collect_list(row).over(frame))
    kept = list(keys) + ["split", "rn", "rn_split", ts, out]
    extra = [c for c in (L.HALO, L.BLK) if c in laid.columns]
    return L.drop_halo(laid.where(window_end(W, step)).select(*kept, *extra))


def window_count(T: Column, W: int, step: int) -> Column:
    """G3 closed form: ``max(0, floor((T - W) / step) + 1)``."""
    return F.greatest(F.lit(0), F.floor((T - F.lit(W)) / F.lit(step)) + F.lit(1)).cast("long")


def short_series(df: DataFrame, keys: Sequence[str], W: int, step: int = 1) -> DataFrame:
    """Windows per series, and ``too_short`` where the series has fewer than ``W`` rows."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(*keys, "n_rows", window_count(F.col("n_rows"), W, step).alias("n_windows"),
                    F.when(F.col("n_rows") < W, F.lit("too_short")).otherwise(F.lit("ok")).alias("status"))


def window_shape(win: DataFrame, keys: Sequence[str], col: str = "win") -> DataFrame:
    """Number of windows and their ``(L, C)`` per series and split."""
    return (win.groupBy(*keys, "split")
            .agg(F.count(F.lit(1)).alias("n_windows"), F.max(F.size(col)).alias("L"),
                 F.max(F.size(F.col(col)[0])).alias("C")))


def window_summary(win: DataFrame, keys: Sequence[str], col: str = "win") -> DataFrame:
    """Window arrays reduced to sum, first and last element (for comparisons without arrays)."""
    flat = F.flatten(F.col(col))
    return win.select(*keys, "split", "ts",
                      F.aggregate(flat, F.lit(0.0), lambda a, x: a + x).alias("win_sum"),
                      F.element_at(flat, 1).alias("win_first"), F.element_at(flat, -1).alias("win_last"),
                      F.size(flat).alias("n_elems"))


__all__ = ["ensure_split", "sliding_windows", "short_series", "window_shape", "window_summary",
           "window_count", "window_end"]
