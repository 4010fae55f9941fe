"""Frequency inference, expected grid, irregularity, resampling with forward fill, gaps.

Frequencies are fixed steps or calendar rules (``operators.calendar``: months, quarters, years, business days, weeks); grids
of both are numbered points, so one plan explodes and fills them.

Grids are generated in two levels (chunk starts, then points inside a chunk), so neither a long series nor a
long gap becomes one object. A grid much larger than the data (defect X14) is a verdict on that series
(``grid_verdicts``): it gets no grid points, and the others go on. Its rows are left out of the resampled ones, or
kept as they are (``keep_large``, as ``flows.prepare`` does).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.columns import micros
from seriesguard.operators import calendar
from seriesguard.operators.calendar import DAY_US
from seriesguard.plans import layout as L

GRID_CHUNK = 4096


def with_deltas(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
                rows_per_block: int = L.ROWS_PER_BLOCK, max_rows: int | None = None) -> DataFrame:
    """Time since the previous row of the series, in microseconds (null on the first row)."""
    if "delta_us" in df.columns:
        return df
    if "rn" not in df.columns:
        df = L.row_index(df, keys, ts, tiebreak, max_rows=max_rows)
    laid = L.with_blocks(df, keys, 1, rows_per_block=rows_per_block, max_rows=max_rows)
    prev = F.lag(F.col(ts), 1).over(L.seq_window(laid, keys))
    laid = laid.withColumn("delta_us", micros(F.col(ts)) - micros(prev))
    return L.drop_halo(laid)


def _delta_groups(d: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One partial aggregate per ``(series, step)`` that all frequency statistics are derived from."""
    t = F.col(ts)
    return d.groupBy(*keys, "delta_us").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_seen"),
        F.min(micros(t)).alias("min_us"), F.max(micros(t)).alias("max_us"), *calendar.step_columns(ts))


def _frequency(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D6 + D7 + bounds per series from the per-step groups (the null step is the first row)."""
    step = F.col("delta_us")
    rank = F.when(step.isNotNull(), F.struct(F.col("n"), (-micros(F.col("first_seen"))).alias("neg_first")))
    agg = groups.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.count(step).alias("n_steps"), F.min(step).alias("min_step"), F.max(step).alias("max_step"),
        F.sum(step).alias("sum_steps"),
        F.max_by(step, rank).alias("modal_us"), F.max_by(F.when(step.isNotNull(), F.col("n")), rank).alias("modal_n"),
        F.min("min_us").alias("min_us"), F.max("max_us").alias("max_us"), *calendar.merged_steps())
    ruled = calendar.with_rule(agg)
    kind = calendar.kind_of()
    return ruled.select(*keys, "n_rows", "n_steps", "min_step", "modal_us", "modal_n", "min_us", "max_us", "rule", "rule_n", "anchor",
                        kind.alias("freq_kind"), F.coalesce(F.when(kind == "fixed", F.col("min_step")), F.col("modal_us")).alias("freq_us"))


def frequency(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
              max_rows: int | None = None) -> DataFrame:
    """Per series: rows, first/last time, inferred kind, modal step and grid step (one layout, two aggregates)."""
    return _frequency(_delta_groups(with_deltas(df, keys, ts, tiebreak, max_rows=max_rows), keys, ts), keys)


def modal_delta(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Most common time step per series; ties go to the step seen first."""
    f = frequency(df, keys, ts, tiebreak).where(F.col("modal_us").isNotNull())
    return f.select(*keys, F.col("modal_us").alias("delta_us"), F.col("modal_n").alias("n"))


def infer_freq(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """``freq_kind`` (``fixed``: one distinct step, ``freq_us``; a calendar rule such as ``month`` (starts), ``quarter_end``, ``business_day``,
    ``week_of_month``; or null) and ``freq``, the rule's full name, such as ``15min``, ``ME``, ``2QS-OCT``; needs at least 3 rows."""
    f = frequency(df, keys, ts, tiebreak)
    return f.select(*keys, "freq_kind", calendar.alias_of().alias("freq"),
                    F.when(F.col("freq_kind") == "fixed", F.col("min_step")).alias("freq_us"))


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    us = micros(F.col(ts))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min(us).alias("min_us"),
                                 F.max(us).alias("max_us"))


def _time_of_day():
    """What an expected range adds to its points: the first row's time of day, where points lie at midnight."""
    midnight = (F.col("_g_unit") != "us") | F.col("_g_wd").isNotNull()
    return F.when(midnight, F.pmod(F.col("min_us"), F.lit(DAY_US))).otherwise(F.lit(0).cast("long"))


def irregularity(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
                 max_rows: int | None = None, freq_us: int | None = None, rule: str | None = None) -> DataFrame:
    """Expected grid length from first to last row at the series' frequency, compared by length only.

    A given ``freq_us`` or ``rule`` (an alias, such as ``ME`` or ``W-MON``) takes the place of the inferred frequency. Series with
    the rhythm of business hours count as regular."""
    f = frequency(df, keys, ts, tiebreak, max_rows=max_rows)
    if freq_us is not None and rule is not None:
        raise ValueError("give a step or a rule")
    if freq_us is not None:
        f = f.withColumn("freq_us", F.lit(int(freq_us)).cast("long")).withColumn("rule", F.lit(None).cast("string"))
    if rule is not None:
        name, n, anchor = calendar.parse_rule(rule)
        step = {**calendar.FIXED_US, "W": 7 * DAY_US}.get(name)
        f = f.withColumns({"rule": F.lit(name), "rule_n": F.lit(n).cast("long"), "anchor": F.lit(anchor).cast("string")})
        if step:
            f = f.withColumn("freq_us", F.lit(n * step).cast("long"))
    if freq_us is not None or rule is not None:
        f = f.withColumn("freq_kind", calendar.kind_of())
    g = calendar.with_grid(f, forward=True).withColumn("_past", F.col("max_us") - _time_of_day() + F.lit(1))
    g = calendar.with_first_at(g, "_past", "_points").drop("_past")
    g = g.withColumn("expected_len", F.when(F.col("_g_step") > 0, F.greatest("_points", F.lit(0).cast("long")))).drop("_points")
    uneven = F.coalesce(F.col("expected_len") != F.col("n_rows"), F.lit(False)) & ~F.coalesce(F.col("freq_kind") == "business_hour", F.lit(False))
    g = g.withColumn("is_irregular", uneven)
    # one row a series already; without this step the optimizer would copy filters on these columns into all expressions above
    found = g.groupBy(*keys).agg(F.any_value(F.struct(*[c for c in g.columns if c not in keys])).alias("_found"))
    return found.select(*keys, "_found.*")


def _too_large(max_grid_ratio: float):
    """More than ``max_grid_ratio`` grid points for each row (and a few)."""
    return F.coalesce(F.col("expected_len") > F.col("n_rows") * F.lit(float(max_grid_ratio)) + F.lit(16.0), F.lit(False))


def grid_verdicts(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
                  max_grid_ratio: float = 100.0, max_rows: int | None = None, freq_us: int | None = None) -> DataFrame:
    """X14 per series: ``n_rows``, ``reason`` (null if the grid is no larger than ``max_grid_ratio`` rows allow) and
    ``valid``, for ``runs.route``. Regular series need no grid and are valid."""
    ir = irregularity(df, keys, ts, tiebreak, max_rows, freq_us)
    bad = F.col("is_irregular") & _too_large(max_grid_ratio)
    reason = F.when(bad, F.format_string("grid of %d points for %d rows", F.col("expected_len"), F.col("n_rows")))
    return ir.select(*keys, "n_rows", reason.alias("reason"), (~bad).alias("valid"))


def explode_range(df: DataFrame, lo: str, hi: str, step: str, out: str, chunk: int = GRID_CHUNK,
                   spread: bool = True) -> DataFrame:
    """Rows for ``lo, lo+step, ... <= hi`` in two levels; with ``spread`` the chunks are dealt over the tasks."""
    span = F.col(step) * F.lit(chunk)
    starts = (df.where(F.col(lo) <= F.col(hi))
              .withColumn("_c0", F.explode(F.sequence(F.col(lo), F.col(hi), span))))
    if spread:
        starts = starts.repartition("_c0")
    last = F.least(F.col(hi), F.col("_c0") + span - F.col(step))
    return starts.withColumn(out, F.explode(F.sequence(F.col("_c0"), last, F.col(step)))).drop("_c0")


def expected_grid(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = (),
                  max_grid_ratio: float = 100.0, rule: str | None = None) -> DataFrame:
    """Every grid point from the first row to the last at the series' frequency (or at ``rule``); series with a grid larger
    than ``max_grid_ratio`` allows are left out (``grid_verdicts``)."""
    ir = irregularity(df, keys, ts, tiebreak, rule=rule).where(~_too_large(max_grid_ratio) & (F.col("_g_step") > 0))
    one = F.lit(1).cast("long")
    ir = ir.withColumns({"_lo": one - 1, "_hi": F.col("expected_len") - 1, "_one": one})
    g = calendar.with_point(explode_range(ir, "_lo", "_hi", "_one", "_k"), "_k", "_g")
    return g.select(*keys, F.timestamp_micros(F.col("_g") + _time_of_day()).alias(ts))


def grid_gaps(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Expected grid points with no row (grid left-anti data)."""
    g = expected_grid(df, keys, ts, tiebreak)
    return g.join(df.select(*keys, ts), list(keys) + [ts], "left_anti")


def resample_ffill(df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str = "ts",
                   tiebreak: Sequence[str] = (), keep_leading: bool = False, only_irregular: bool = True,
                   max_grid_ratio: float = 100.0, rows_per_block: int = L.ROWS_PER_BLOCK,
                   max_rows: int | None = None, freq_us: int | None = None, keep_large: bool = False,
                   rule: str | None = None) -> DataFrame:
    """Grid anchored at midnight of the first day; a grid point takes the last row at or before it.

    Grids of calendar rules lie on the rule's dates, at midnight: of rules at starts (``MS``, ``QS-OCT``, ``B``, ``WOM-2TUE``) from the last date
    at or before the first row, of rules at ends and weeks (``ME``, ``YE-DEC``, ``W-MON``) up to the first date that covers the last row.

    Rows must be unique per ``(series, ts)`` (run D2 first). Each row emits the grid points between the
    previous row and itself, with the previous row's values (one ``lag``), so no as-of join and no
    per-series sort is needed. The point before the first row is null and dropped unless
    ``keep_leading`` (X15). With ``only_irregular`` regular series pass through unchanged (D9).
    ``freq_us`` or ``rule`` replaces the inferred frequency (D6/D7), and a series is regular if it fits that. Irregular
    series with a grid larger than ``max_grid_ratio`` allows are left out (``grid_verdicts`` names them), or with
    ``keep_large`` keep their rows as they are.
    """
    keys = list(keys)
    ir = irregularity(df, keys, ts, tiebreak, max_rows=max_rows, freq_us=freq_us, rule=rule)
    resampled = F.col("_g_step").isNotNull() & (F.col("is_irregular") if only_irregular else F.lit(True))
    series = ir.select(*[c for c in ir.columns if not c.startswith("_g_")], resampled.alias("_resampled"), _too_large(max_grid_ratio).alias("_large"))
    series = calendar.with_grid(series)
    params = series.select(*keys, F.col("n_rows").alias("_n_rows"), "_resampled", "_large", *[c for c in series.columns if c.startswith("_g_")])
    base = df.join(params, keys)
    work = base.where(F.col("_resampled") & ~F.col("_large"))
    us = micros(F.col(ts))
    work = work.withColumns({"_us": us, "_past_us": us + F.lit(1), "_day_us": us - F.pmod(us, F.lit(DAY_US))})
    for at, of in (("_at", "_us"), ("_past", "_past_us"), ("_day_at", "_day_us")):
        work = calendar.with_first_at(work, of, at)
    if "rn" not in work.columns:
        work = L.row_index(work, keys, ts, tiebreak, count_col=None, max_rows=max_rows)
    laid = L.with_blocks(work, keys, 1, rows_per_block=rows_per_block, max_rows=max_rows)
    w = L.seq_window(laid, keys)
    before = [F.when(F.col("rn") > 0, F.lag(F.col(c), 1).over(w)).alias(f"_b_{c}") for c in cols]
    laid = L.drop_halo(laid.select("*", F.lag("_at", 1).over(w).alias("_prev_at"), *before))
    # a row gives the points from the previous row on up to itself, with the previous row's values; the last one also those
    # that it closes or lies on, with its own
    up_to = F.col("_past") - 1  # the last point at or before the row
    lo = F.when(F.col("rn") == 0, F.greatest(up_to, F.lit(0).cast("long"))).otherwise(F.col("_prev_at"))
    closed = F.when(F.col("_g_right"), F.greatest(F.col("_day_at"), F.col("_at") - 1)).otherwise(up_to)
    hi = F.when(F.col("rn") == F.col("_n_rows") - 1, closed).otherwise(F.col("_at") - 1)
    gaps = laid.withColumns({"_lo": lo, "_hi": hi, "_one": F.lit(1).cast("long")})
    big = max_rows is not None and max_rows > rows_per_block
    points = calendar.with_point(explode_range(gaps, "_lo", "_hi", "_one", "_k", spread=big), "_k", "_g")
    if not keep_leading:
        points = points.where((F.col("rn") > 0) | (F.col("_g") >= F.col("_us")))
    out = points.select(*keys, F.timestamp_micros("_g").alias(ts),
                        *[F.when(F.col("_g") >= F.col("_us"), F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c) for c in cols])
    if only_irregular or keep_large:
        as_is = (~F.col("_resampled") & F.lit(only_irregular)) | (F.col("_resampled") & F.col("_large") & F.lit(keep_large))
        out = out.unionByName(base.where(as_is).select(*keys, ts, *cols))
    return out
