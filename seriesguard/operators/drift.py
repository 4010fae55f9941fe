"""K1-K9: metric samples, last-write-wins, as-of evaluation ticks, drift pairs and alert rules.

The metric table is long: ``(metric, feature, model_version, env, ts, value)``; ``feature`` is the
feature name or ``''`` for unlabelled gauges (feature names as labels, defect X7 fixed). A series is one
``model_version``, all of its keys joined by ``/``. Rules are a tiny constant table broadcast to the evaluation.

A gauge keeps its value until the next sample, so rules are evaluated on the intervals between samples: conditions,
hold times and messages at ticks of 30 s cost one row per sample, not per tick. ``metric_asof`` gives the ticks
themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesguard.functions.columns import micros
from seriesguard.functions.quantiles import SMALL_GROUP, group_quantiles
from seriesguard.operators import stats
from seriesguard.operators.grid import explode_range
from seriesguard.plans import layout as L

LABELS = ["metric", "feature", "model_version", "env"]
BLOCK_US = 6 * 3600 * 1_000_000
# Fixed value of the reference alert rules: evaluation interval of 30 s.
TICK_US = 30 * 1_000_000

# Fixed values of the reference alert rules: name, metric, comparison, constant, hold, severity, summary.
# The mean-shift rule is applied to every feature (defect X7); ``{feature}`` and ``{model_version}``
# are filled from the labels.
RULES = [
    ("EnsembleErrorMedianHigh", "error_median", "ratio", 2.0, 300, "warning",
     "Median reconstruction error doubled ({model_version})"),
    ("EnsembleErrorP95High", "error_p95", "ratio", 2.0, 300, "critical",
     "95th percentile error > 2x baseline ({model_version})"),
    ("AnomalyRateSpike", "anomaly_rate", "scaled", 3.0, 600, "critical",
     "Anomaly rate > 3x baseline ({model_version})"),
    ("FeatureMeanShift", "feature_mean", "shift", 0.5, 600, "warning",
     "Feature[{feature}] mean drift > 0.5 ({model_version})"),
]


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RULES, "alert string, base string, kind string, c double, hold_s int, severity string, summary string")


def _version(keys: Sequence[str]):
    """All keys of a series as one label, different for different keys: a backslash or slash inside a key has a backslash before
    it, and a null key is ``\\N``."""
    def escaped(k: str):
        text = F.col(k).cast("string")
        return F.coalesce(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("/"), F.lit("\\/")), F.lit("\\N"))

    return F.concat_ws("/", *map(escaped, keys)).alias("model_version")


def _samples(df: DataFrame, keys: Sequence[str], ts: str, suffix: str, scalars: Sequence[tuple[str, str]], features: bool) -> DataFrame:
    """Wide statistics as samples: one row per gauge, and per feature for ``features``."""
    entry = lambda m, f, v: F.struct(F.lit(m + suffix).alias("metric"), f.alias("feature"), v.cast("double").alias("value"))
    entries = F.array(*[entry(m, F.lit(""), F.col(c)) for m, c in scalars])
    if features:
        none = F.expr("cast(array() as array<struct<metric:string,feature:string,value:double>>)")

        def per_feature(m: str):
            return F.coalesce(F.transform("features", lambda e: entry(f"feature_{m}", e["feature"], e[m])), none)

        entries = F.concat(entries, per_feature("mean"), per_feature("std"))
    return (df.select(_version(keys), F.col(ts).alias("ts"), F.explode(entries).alias("_e"))
            .select("_e.metric", "_e.feature", "model_version", "ts", "_e.value"))


GLOBALS = [("feature_global_mean", "global_mean"), ("feature_global_std", "global_std")]
ERRORS = [("error_median", "median"), ("error_p95", "p95"), ("anomaly_rate", "anomaly_rate")]


def _error_stats(win: DataFrame, by: Sequence[str], n_max: int | None) -> DataFrame:
    """Median, p95 and anomaly rate of scored windows; one aggregate when the groups are known to be small."""
    if n_max is not None and n_max <= SMALL_GROUP:
        return win.groupBy(*by).agg(F.percentile("score", 0.5).alias("median"), F.percentile("score", 0.95).alias("p95"),
                                    F.avg("flag").alias("anomaly_rate")).where(F.col("median").isNotNull())
    es = group_quantiles(win, by, "score", {"median": 0.5, "p95": 0.95}, max_group=n_max)
    return es.join(win.groupBy(*by).agg(F.avg("flag").alias("anomaly_rate")), list(by))


def reference_samples(fitted, keys: Sequence[str], cols: Sequence[str], W: int = 16, step: int = 1) -> DataFrame:
    """Reference gauges of every series, stamped at the end of its validation split."""
    keys = list(keys)
    ref_ts = fitted.scaled.where(F.col("split") == "val").groupBy(*keys).agg(F.max("ts").alias("_ref_ts"))
    ref = stats.reference_stats(fitted.scaled, keys, cols, W, step)
    es = _error_stats(fitted.flagged.where(F.col("split") == "val"), keys, fitted.n_max)
    both = ref_ts.join(ref, keys, "left").join(es, keys, "left")
    return _samples(both, keys, "_ref_ts", "_ref", [*GLOBALS, *ERRORS], True).where(F.col("value").isNotNull())


def block_end(ts, block_us: int = BLOCK_US):
    return F.timestamp_micros((F.floor(micros(ts) / F.lit(block_us)) + F.lit(1)) * F.lit(block_us))


def live_samples(fitted, keys: Sequence[str], cols: Sequence[str], split: str = "test",
                 block_us: int = BLOCK_US) -> DataFrame:
    """Live gauges per block of the scored split, stamped at the end of the block."""
    keys = list(keys)
    rows = fitted.scaled.where(F.col("split") == split).withColumn("_blk_ts", block_end(F.col("ts"), block_us))
    win = fitted.flagged.where(F.col("split") == split).withColumn("_blk_ts", block_end(F.col("ts"), block_us))
    live = stats.live_stats(rows, keys, cols, None, by=["_blk_ts"])
    es = _error_stats(win, [*keys, "_blk_ts"], fitted.n_max)
    return _samples(live, keys, "_blk_ts", "_live", GLOBALS, True).unionByName(_samples(es, keys, "_blk_ts", "_live", ERRORS, False))


def metric_samples(fitted, keys: Sequence[str], cols: Sequence[str], env: str = "prod", **kw) -> DataFrame:
    """K1: reference and live statistics as labelled samples."""
    out = reference_samples(fitted, keys, cols).unionByName(live_samples(fitted, keys, cols, **kw))
    return out.select("metric", "feature", "model_version", F.lit(env).alias("env"), "ts", "value")


def metric_latest(samples: DataFrame) -> DataFrame:
    """K2: last write wins per label set."""
    return samples.groupBy(*LABELS).agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))


def live_intervals(samples: DataFrame, tick_us: int = TICK_US, lookback_us: int | None = None, suffix: str = "_live",
                   rows_per_block: int = L.ROWS_PER_BLOCK, max_rows: int | None = None) -> DataFrame:
    """Every live sample with the evaluation ticks at which it is the gauge's value: from the first tick at or after it up to
    the last one before the next sample (or at the model version's last sample). ``_lo``, ``_hi`` in microseconds;
    samples without a tick are left out. A gauge keeps its value for good unless ``lookback_us`` is given.

    A label set with more than ``rows_per_block`` samples is cut into blocks; the next sample across a border comes from a copied row.
    ``max_rows`` (samples of the largest label set) saves the job that counts them."""
    live = samples.where(F.col("metric").endswith(suffix))
    # the last write of a label set and time wins
    live = live.groupBy(*LABELS, "ts").agg(F.max("value").alias("value"))
    us = micros(F.col("ts"))
    end = live.groupBy("model_version").agg(F.max(us).alias("_end"))
    if max_rows is None:
        max_rows = L.max_series_rows(live, LABELS)
    if max_rows <= rows_per_block:
        rows = live.withColumn("_us", us).withColumn("_next", F.lead(us).over(Window.partitionBy(*LABELS).orderBy("ts")))
    else:  # numbered from the last sample, so that looking back one row is looking at the next sample
        numbered = L.row_index(live, LABELS, "ts", rows_per_segment=rows_per_block, max_rows=max_rows)
        numbered = numbered.withColumn("_us", us).withColumn("rn", F.col("n_rows") - 1 - F.col("rn"))
        laid = L.with_blocks(numbered, LABELS, 1, rows_per_block=rows_per_block, max_rows=max_rows)
        rows = L.drop_halo(laid.withColumn("_next", F.lag("_us", 1).over(L.seq_window(laid, LABELS))))
    rows = rows.join(end, "model_version")
    last = F.coalesce(F.col("_next") - 1, F.col("_end"))
    if lookback_us is not None:
        last = F.least(last, F.col("_us") + F.lit(lookback_us))
    tick = F.lit(tick_us)
    rows = rows.select(*LABELS, "value", (F.ceil(F.col("_us") / tick) * tick).cast("long").alias("_lo"),
                       (F.floor(last / tick) * tick).cast("long").alias("_hi"))
    return rows.where(F.col("_lo") <= F.col("_hi"))


def metric_asof(samples: DataFrame, tick_us: int = TICK_US, lookback_us: int | None = None,
                suffix: str = "_live") -> DataFrame:
    """K3: value of every live gauge at evaluation ticks (the last sample at or before the tick)."""
    rows = live_intervals(samples, tick_us, lookback_us, suffix).withColumn("_step", F.lit(tick_us).cast("long"))
    ticks = explode_range(rows, "_lo", "_hi", "_step", "_t", spread=False)
    return ticks.select(*LABELS, F.timestamp_micros("_t").alias("ts"), "value")


def _reference(samples: DataFrame) -> DataFrame:
    return (metric_latest(samples.where(F.col("metric").endswith("_ref")))
            .select(F.regexp_replace("metric", "_ref$", "").alias("base"), "feature", "model_version", "env",
                    F.col("value").alias("ref")))


def _paired(live: DataFrame, samples: DataFrame) -> DataFrame:
    live = live.withColumn("base", F.regexp_replace("metric", "_live$", "")).withColumnRenamed("value", "live")
    return live.drop("metric").join(_reference(samples), ["base", "feature", "model_version", "env"])


def drift_pairs(samples: DataFrame, **kw) -> DataFrame:
    """K4: live value at each tick next to the latest reference value with equal labels."""
    return _paired(metric_asof(samples, **kw), samples).select("base", "feature", "model_version", "env", "ts", "live", "ref")


def drift_intervals(samples: DataFrame, **kw) -> DataFrame:
    """K4 on intervals: ``_lo`` and ``_hi`` are the first and last tick of a pair."""
    return _paired(live_intervals(samples, **kw), samples)


def evaluate_rules(pairs: DataFrame, rules: DataFrame, mode: str = "guarded", samples: DataFrame | None = None) -> DataFrame:
    """K5-K7: rule conditions for every pair (of ``drift_pairs`` or ``drift_intervals``).

    ``ratio``: ``live / ref > c`` when ``ref > 0``; when ``ref <= 0`` (z-scored errors, defect X8) the
    guarded mode fires on ``live - ref > (c - 1) * (p95_ref - median_ref)``; ``mode='ratio'`` keeps the
    plain ratio. ``scaled``: ``live > c * ref``. ``shift``: ``|live - ref| > c``. The spread is a function of the
    references: read from ``samples`` if given, else from the pairs.
    """
    at = [c for c in ("ts", "_lo", "_hi") if c in pairs.columns]
    of = lambda m: F.max(F.when(F.col("base") == m, F.col("ref")))
    refs = _reference(samples) if samples is not None else pairs
    spread = refs.groupBy("model_version", "env").agg((of("error_p95") - of("error_median")).alias("_spread"))
    j = pairs.join(F.broadcast(rules), pairs["base"] == rules["base"]).drop(rules["base"])
    j = j.join(spread, ["model_version", "env"], "left")
    ratio = F.try_divide(F.col("live"), F.col("ref")) > F.col("c")
    guarded = F.when(F.col("ref") > 0, ratio).otherwise(
        (F.col("live") - F.col("ref")) > (F.col("c") - F.lit(1.0)) * F.col("_spread"))
    cond = (F.when(F.col("kind") == "ratio", ratio if mode == "ratio" else guarded)
            .when(F.col("kind") == "scaled", F.col("live") > F.col("c") * F.col("ref"))
            .otherwise(F.abs(F.col("live") - F.col("ref")) > F.col("c")))
    return j.select("alert", "feature", "model_version", "env", *at, "live", "ref",
                    F.coalesce(cond, F.lit(False)).alias("active"), "hold_s", "severity", "summary")


def _runs(conds: DataFrame, key: list[str], rows_per_block: int, max_rows: int | None) -> DataFrame:
    """``conds`` with ``_run``, the number of the run of equal conditions that an interval belongs to. Label sets of more than
    ``rows_per_block`` intervals are scanned in blocks: each counts its own turns, and the turns of the blocks before are added."""
    if max_rows is None:
        max_rows = L.max_series_rows(conds, key)
    turn = lambda w: (F.col("active") != F.coalesce(F.lag("active").over(w), ~F.col("active"))).cast("int")
    if max_rows <= rows_per_block:
        w = Window.partitionBy(*key).orderBy("_lo")
        return conds.withColumn("_turn", turn(w)).withColumn("_run", F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = L.row_index(conds, key, "_lo", count_col=None, rows_per_segment=rows_per_block, max_rows=max_rows)
    laid = L.with_blocks(numbered, key, 1, rows_per_block=rows_per_block, max_rows=max_rows)
    w = L.seq_window(laid, key)
    own = laid.withColumn("_turn", turn(w)).where(~F.col(L.HALO)).drop(L.HALO)
    own = own.withColumn("_inside", F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(*key).orderBy(L.BLK).rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    turns = own.groupBy(*key, L.BLK).agg(F.sum("_turn").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = own.join(turns.drop("_n"), [*key, L.BLK])
    return joined.withColumn("_run", F.col("_before") + F.col("_inside")).drop(L.BLK, "rn", "_inside", "_before")


def alert_states(conds: DataFrame, tick_us: int = TICK_US, rows_per_block: int = L.ROWS_PER_BLOCK, max_rows: int | None = None) -> DataFrame:
    """K8: gaps and islands over intervals. An island of active intervals is pending until it has held for ``hold_s``,
    then firing. One row per label set and run of equal states: ``state``, ``from_ts`` and ``to_ts`` (its first and last
    tick), ``n_ticks`` and ``active_since``. Conditions per tick (``ts``) are intervals of one tick."""
    key = ["alert", "feature", "model_version", "env"]
    if "_lo" not in conds.columns:
        conds = conds.withColumn("_lo", micros(F.col("ts"))).withColumn("_hi", F.col("_lo"))
    runs = (_runs(conds, key, rows_per_block, max_rows)
            .groupBy(*key, "severity", "summary", "hold_s", "_run", "active").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")))
    tick = F.lit(tick_us)
    held = (F.ceil((F.col("_lo") + F.col("hold_s").cast("long") * 1_000_000) / tick) * tick).cast("long")
    part = lambda state, lo, hi: F.struct(F.lit(state).alias("state"), lo.alias("lo"), hi.alias("hi"))
    parts = F.when(F.col("active"), F.array(part("pending", F.col("_lo"), F.least(F.col("_hi"), held - tick)),
                                            part("firing", held, F.col("_hi")))).otherwise(F.array(part("inactive", F.col("_lo"), F.col("_hi"))))
    out = runs.select(*key, "severity", "summary", F.when(F.col("active"), F.timestamp_micros("_lo")).alias("active_since"),
                      F.explode(parts).alias("_p")).where(F.col("_p.lo") <= F.col("_p.hi"))
    return out.select(*key, "severity", "summary", "_p.state", F.timestamp_micros("_p.lo").alias("from_ts"),
                      F.timestamp_micros("_p.hi").alias("to_ts"),
                      ((F.col("_p.hi") - F.col("_p.lo")) / tick + 1).cast("long").alias("n_ticks"), "active_since")


def alert_messages(states: DataFrame) -> DataFrame:
    """K9: one message per firing episode, at the tick it starts firing."""
    key = ["alert", "feature", "model_version", "env", "active_since"]
    first = states.where(F.col("state") == "firing").groupBy(*key, "severity", "summary").agg(
        F.min("from_ts").alias("fired_at"))
    msg = F.replace(F.replace(F.col("summary"), F.lit("{model_version}"), F.col("model_version")),
                    F.lit("{feature}"), F.col("feature"))
    return first.select("alert", "feature", "model_version", "env", "severity", "active_since", "fired_at",
                        msg.alias("message"))
