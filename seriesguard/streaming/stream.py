"""The event stream, scored on executors with state kept per source.

Plan: source (Kafka, or files locally) -> parse by the contract's features, with a reject branch -> scale and H1 row
errors (stream-static joins with the frozen parameters) -> ``groupBy(source).transformWithStateInPandas`` -> score and flag
with the frozen normalisers and thresholds -> sink with a checkpoint. Nothing goes through the driver.

The stateful step orders rows by event time. A source's watermark is its newest event time minus the allowed delay;
rows wait in a list state until the watermark passes them, so disorder within the delay changes nothing, and rows at
or before the last one released come out as ``late``. Released rows continue the source's series: the last
``W - 1 + lags`` rows and a row counter are kept, so windows span micro-batches and equal the batch windows. A batch that
releases nothing only appends its rows to the state. A source that falls silent has a timer: after ``idle`` its waiting rows
are released. Rows too far in the future come out as ``ahead`` and don't move the watermark. When scoring fails for one source, its
released rows come out as ``error`` rows and its series goes on behind them; the other sources aren't touched.
"""

from __future__ import annotations

import math
import time
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from seriesguard.functions.columns import q
from seriesguard.operators import drift
from seriesguard.operators.recon import EWMA_WEIGHTS, LOCAL_KERNEL, MODELS
from seriesguard.sources import events as ev_src

NO_SOURCE = "_"
DOUBLES = T.ArrayType(T.DoubleType())
WAIT_SCHEMA = "us long, id long, x array<double>"
KEPT_SCHEMA = "x array<double>"
AT_SCHEMA = "n_seen long, newest_us long, last_us long, oldest_us long, timer_ms long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def out_schema(models: Sequence[str]) -> T.StructType:
    """What the stateful step returns; times are microseconds, so that none is out of the range of the workers' types."""
    return T.StructType([
        T.StructField("source", T.StringType()), T.StructField("us", T.LongType()),
        T.StructField("event_id", T.LongType()), T.StructField("rn", T.LongType()),
        *[T.StructField(f"err__{m}", T.DoubleType()) for m in models], T.StructField("x", DOUBLES),
        T.StructField("status", T.StringType()), T.StructField("message", T.StringType())])


def read_event_stream(spark: SparkSession, path: str | None = None, options: dict | None = None,
                      max_files_per_trigger: int = 1) -> DataFrame:
    """A4: raw messages as a ``value`` string column. ``options`` with ``kafka.bootstrap.servers`` read
    Kafka (needs the connector on the classpath); otherwise new text files under ``path`` are read."""
    options = dict(options or {})
    if "kafka.bootstrap.servers" in options:
        reader = spark.readStream.format("kafka")
        options.setdefault("startingOffsets", "latest")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def parse_stream(raw: DataFrame, features: Sequence[str], ts: str = "ts", source: str = "source",
                 default_source: str | None = NO_SOURCE) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of messages with any feature names, flat or under ``features``.

    Messages that aren't objects, lack a time or a feature, or hold one that can't be read (``bad time``, ``bad:<name>``)
    are rejected with a reason. A null source is ``default_source``; without one it is rejected too."""
    schema = ev_src.event_schema(features, ts, source)
    parsed = ev_src.parse_events(raw.select(F.col("value").alias("_raw")), raw="_raw", schema=schema, keep=["_raw"])
    parsed = ev_src.expand_features(parsed, list(features)).withColumn("_ts", F.try_to_timestamp(F.col(ts)))
    given = lambda *paths: F.coalesce(*[F.get_json_object("_raw", f"$['{x}']" if n is None else f"$['{n}']['{x}']")
                                        for n, x in paths]).isNotNull()
    why = [F.when(F.col(ts).isNull(), F.lit(f"missing:{ts}")), F.when(F.col("_ts").isNull(), F.lit("bad time"))]
    if default_source is None:
        why.append(F.when(F.col(source).isNull(), F.lit(f"missing:{source}")))
    for c in features:
        value = F.col(q(c)).cast("double")
        why.append(F.when(value.isNull() | F.isnan(value), F.when(given((None, c), ("features", c)), F.lit(f"bad:{c}"))
                          .otherwise(F.lit(f"missing:{c}"))))
    reason = F.when(F.col("_raw").isNull(), F.lit("null")).when(~F.col("_ok"), F.lit("malformed")).otherwise(F.coalesce(*why))
    judged = parsed.withColumn("_reason", reason)
    good = judged.where(F.col("_reason").isNull()).select(
        F.coalesce(F.col(source), F.lit(default_source)).alias("source"), F.col("event_id"), F.col("_ts").alias("ts"),
        *[F.col(q(c)).cast("double").alias(c) for c in features])
    bad = judged.where(F.col("_reason").isNotNull()).select(F.col("_raw").alias("raw"), F.col("_reason").alias("reason"))
    return good, bad


def _window_errors(X: np.ndarray, seasonal: np.ndarray, start: int, first: int, W: int, step: int, models: Sequence[str],
                   weights: np.ndarray, kernel: Sequence[float], extra: dict[str, Callable]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Positions in ``X`` (from ``first`` on) where windows end, and each model's window errors.

    ``X`` is a stretch of a series that begins at row ``start``; the formulas are those of the batch detectors."""
    n, K = len(X), len(weights)
    g = start + np.arange(n)
    ends = np.arange(first, n)
    ends = ends[(ends >= W - 1) & (g[ends] >= W - 1) & ((g[ends] - (W - 1)) % step == 0)]
    if not len(ends):
        return ends, {m: np.zeros(0) for m in [*models, *extra]}
    wins = np.lib.stride_tricks.sliding_window_view(X, W, axis=0)[ends - W + 1].transpose(0, 2, 1)
    out = {}
    for m in models:
        if m == "local":
            kl, kc, kr = (float(k) for k in kernel)
            rec = np.empty_like(wins)
            rec[:, 0] = (kc * wins[:, 0] + kr * wins[:, 1]) / (kc + kr)
            rec[:, 1:-1] = (kl * wins[:, :-2] + kc * wins[:, 1:-1] + kr * wins[:, 2:]) / (kl + kc + kr)
            rec[:, -1] = (kl * wins[:, -2] + kc * wins[:, -1]) / (kl + kc)
            out[m] = ((wins - rec) ** 2).mean(axis=(1, 2))
            continue
        if m == "seasonal":
            row = seasonal
        else:
            num, den = np.zeros_like(X), np.zeros(n)
            for k in range(1, K + 1):
                has = (g >= k) & (np.arange(n) >= k)
                num[has] += weights[k - 1] * X[np.flatnonzero(has) - k]
                den[has] += weights[k - 1]
            with np.errstate(invalid="ignore", divide="ignore"):
                row = ((X - num / den[:, None]) ** 2).mean(axis=1)
        rows = np.lib.stride_tricks.sliding_window_view(row, W)[ends - W + 1]
        known = ~np.isnan(rows)
        first_row = (m == "ewma") & (g[ends] == W - 1)  # the series' first row has nothing to be reconstructed from
        whole = known.sum(axis=1) == W - first_row
        out[m] = np.where(whole, np.where(known, rows, 0).sum(axis=1) / np.maximum(known.sum(axis=1), 1), np.nan)
    for m, fn in extra.items():
        out[m] = np.asarray(fn(wins), dtype=float)
    return ends, out


class _SourceWindows(StatefulProcessor):
    """A source's state: ``wait`` (rows the watermark hasn't passed), ``kept`` (the last rows of its series) and ``at`` (counters)."""

    def __init__(self, features: Sequence[str], W: int, step: int, delay_us: int, idle_ms: int | None, ahead_us: int, models: Sequence[str],
                 weights: Sequence[float], kernel: Sequence[float], extra: dict[str, Callable]):
        self.wide, self.W, self.step, self.delay_us, self.idle_ms, self.ahead_us = len(features), W, step, delay_us, idle_ms, ahead_us
        self.models, self.weights, self.kernel, self.extra = list(models), np.asarray(weights, dtype=float), list(kernel), dict(extra)
        self.names = [f.name for f in out_schema([*self.models, *self.extra]).fields]

    def init(self, handle) -> None:
        self.handle = handle
        self.wait = handle.getListState("wait", WAIT_SCHEMA)
        self.kept = handle.getListState("kept", KEPT_SCHEMA)
        self.at = handle.getValueState("at", AT_SCHEMA)

    def close(self) -> None:
        pass

    def _rows(self, n: int, **cols) -> pd.DataFrame:
        return pd.DataFrame({c: cols.get(c, [None] * n) for c in self.names})

    def _passed_on(self, source: str, rows: list[tuple[int, int | None]], status: str) -> pd.DataFrame:
        return self._rows(len(rows), source=[source] * len(rows), us=[u for u, _ in rows],
                          event_id=[i for _, i in rows], status=[status] * len(rows))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n_seen, newest, last, oldest, timer = self.at.get() if self.at.exists() else (0, None, None, None, None)
        limit = int(time.time() * 1e6) + self.ahead_us
        fresh, late, ahead = [], [], []
        for pdf in rows:  # one Arrow batch at a time
            us = pdf["us"].tolist()
            ids = [None if i is None or i != i else int(i) for i in pdf["event_id"].tolist()]
            for u, i, x in zip(us, ids, pdf["xs"], strict=True):
                if u > limit:
                    ahead.append((u, i))
                    continue
                if last is not None and u <= last:
                    late.append((u, i))
                else:
                    fresh.append((u, i, [math.nan if v is None else float(v) for v in x]))
                newest = u if newest is None else max(newest, u)
        for found, status in ((late, "late"), (ahead, "ahead")):
            if found:
                yield self._passed_on(key[0], found, status)
        if fresh:
            self.wait.appendList(fresh)
            oldest = min(r[0] for r in fresh) if oldest is None else min(oldest, *(r[0] for r in fresh))
        if oldest is not None and oldest <= newest - self.delay_us:
            out, n_seen, last, oldest = self._release(key[0], newest - self.delay_us, n_seen)
            yield from out
        if self.idle_ms is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = None if oldest is None else int(time.time() * 1000) + self.idle_ms
            if timer is not None:
                self.handle.registerTimer(timer)
        self.at.update((n_seen, newest, last, oldest, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No row came for ``idle``: what waits is released."""
        n_seen, newest, last, oldest, _ = self.at.get()
        if oldest is not None:
            out, n_seen, last, oldest = self._release(key[0], newest, n_seen)
            yield from out
        self.at.update((n_seen, newest, last, oldest, None))

    def _release(self, source: str, limit: int, n_seen: int) -> tuple[list[pd.DataFrame], int, int, int | None]:
        """Takes the waiting rows up to a time out of the state: their output, the new row counter, the last time, the oldest that waits."""
        wait = sorted(((int(r[0]), r[1], r[2]) for r in self.wait.get()), key=lambda r: (r[0], -1 if r[1] is None else r[1]))
        n_ready = bisect_right(wait, limit, key=lambda r: r[0])
        released, rest = wait[:n_ready], wait[n_ready:]
        if rest:
            self.wait.put([(u, i, [float(v) for v in x]) for u, i, x in rest])
        else:
            self.wait.clear()
        ready = [r for k, r in enumerate(released) if not k or released[k - 1][0] != r[0]]  # of repeated times the first stays
        kept = [r[0] for r in self.kept.get()] if n_seen else []
        nb = len(kept)
        all_x = np.asarray([*kept, *(r[2] for r in ready)], dtype=float).reshape(-1, self.wide + 1)
        try:
            ends, errs = _window_errors(all_x[:, :self.wide], all_x[:, self.wide], n_seen - nb, nb, self.W, self.step, self.models, self.weights,
                                        self.kernel, self.extra)
            own = [ready[e - nb] for e in ends]
            out = self._rows(len(ends), source=[source] * len(ends), us=[r[0] for r in own],
                             event_id=[r[1] for r in own], rn=(n_seen - nb + ends).tolist(), status=["ok"] * len(ends),
                             x=[list(r[2])[:self.wide] for r in own], **{f"err__{m}": v for m, v in errs.items()})
        except Exception as e:  # noqa: BLE001 - one source's failure is its own
            out = self._passed_on(source, [(r[0], r[1]) for r in ready], "error")
            out["rn"], out["message"] = [n_seen + k for k in range(len(ready))], [f"{type(e).__name__}: {e}"[:500]] * len(ready)
        self.kept.put([(x,) for x in all_x[-(self.W - 1 + len(self.weights)):].tolist()])
        return [out] if len(out) else [], n_seen + len(ready), ready[-1][0], (rest[0][0] if rest else None)


def _micros_of(delay: str) -> int:
    return int(pd.Timedelta(delay) / pd.Timedelta(microseconds=1))


def stateful_windows(events: DataFrame, features: Sequence[str], W: int = 16, step: int = 1, weights: Sequence[float] = EWMA_WEIGHTS,
                     watermark: str = "1 hour", models: Sequence[str] = ("ewma",), kernel: Sequence[float] = LOCAL_KERNEL,
                     extra: dict[str, Callable] | None = None, idle: str | None = None, max_ahead: str = "1 day") -> DataFrame:
    """Window errors of each source's ``W`` rows across micro-batches.

    ``events`` has ``source``, ``event_id``, ``ts``, the features and, for H1, ``seasonal_err`` (``with_seasonal``). ``extra`` maps names
    to functions of a batch of windows (n, W, C) that return n errors. Output rows have ``status`` ``ok`` (one per window:
    ``err__<model>``, and ``x``, its last row), ``late`` (one per late row), ``ahead`` (one per row more than ``max_ahead`` past the clock) or ``error``
    (one per released row, with ``message``). With ``idle`` the rows that wait are released when their source sends nothing
    for that long. The session's state store becomes RocksDB, which keyed state needs."""
    unknown = set(models) - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    if "seasonal_err" not in events.columns:
        if "seasonal" in models:
            raise ValueError("the seasonal model needs with_seasonal() before")
        events = events.withColumn("seasonal_err", F.lit(None).cast("double"))
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    idle_ms = None if idle is None else max(1, _micros_of(idle) // 1000)
    processor = _SourceWindows(features, W, step, _micros_of(watermark), idle_ms, _micros_of(max_ahead), models, weights, kernel, extra or {})
    packed = events.select("source", "event_id", F.unix_micros("ts").alias("us"), F.array(*[F.col(q(c)).cast("double") for c in features], "seasonal_err").alias("xs"))
    out = packed.groupBy("source").transformWithStateInPandas(
        processor, out_schema([*models, *(extra or {})]), "Append", "None" if idle is None else "ProcessingTime")
    # a projection makes plain rows of the columnar ones; joins and exchanges right above the step need them
    plain = {"us": F.timestamp_micros("us").alias("ts"), "status": F.concat(F.col("status"), F.lit("")).alias("status")}
    return out.select(*[plain.get(c, F.col(q(c))) for c in out.columns])


def _with_static(stream: DataFrame, table: DataFrame) -> DataFrame:
    """Stream-static join with parameters per source, or with the one row of a pooled fit."""
    if "source" in table.columns:
        return stream.join(table, "source", "left")
    one = F.lit(1).alias("_one")
    return stream.select("*", one).join(F.broadcast(table.select("*", one)), "_one", "left").drop("_one")


def scale_stream(events: DataFrame, scaler: DataFrame, features: Sequence[str]) -> DataFrame:
    """Stream-static join with the frozen scaler (columns ``mean__c``, ``scale__c`` per source, or one pooled row)."""
    j = _with_static(events, scaler)
    return j.select("source", "event_id", "ts", *[((F.col(q(c)) - F.col(q(f"mean__{c}"))) / F.col(q(f"scale__{c}"))).alias(c)
                                                  for c in features])


def with_seasonal(scaled: DataFrame, means: DataFrame, features: Sequence[str], phase=None) -> DataFrame:
    """H1 on a stream: ``seasonal_err`` of each scaled row against the frozen phase means of its source."""
    phase = F.hour("ts") if phase is None else phase
    j = scaled.withColumn("_phase", phase).join(means, ["source", "_phase"], "left")
    sq = [(F.col(q(c)) - F.col(q(f"seasonal__{c}"))) * (F.col(q(c)) - F.col(q(f"seasonal__{c}"))) for c in features]
    return j.withColumn("seasonal_err", sum(sq[1:], sq[0]) / F.lit(float(len(sq)))).select(*scaled.columns, "seasonal_err")


def score_stream(windows: DataFrame, normalizers: DataFrame | None, thresholds: DataFrame, models: Sequence[str]) -> DataFrame:
    """The ensemble score with frozen parameters, joined as static tables (a row per source, or one of a pooled fit).
    ``normalizers`` has ``model, mean, std`` (and ``source``). Late, early and error rows pass through without a score."""
    by = lambda t: [c for c in ("source",) if c in t.columns]
    j = windows
    parts = []
    for m in models:
        err = F.col(f"err__{m}")
        if normalizers is not None:
            own = normalizers.where(F.col("model") == m).select(*by(normalizers), F.col("mean").alias(f"_mean_{m}"), F.col("std").alias(f"_std_{m}"))
            j = _with_static(j, own)
            std = F.col(f"_std_{m}")
            err = (err - F.col(f"_mean_{m}")) / F.when(std > 0, std).otherwise(F.lit(1.0))
        parts.append(F.when(~F.isnan(err), err))
    known = F.filter(F.array(*parts), lambda e: e.isNotNull())
    score = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, e: a + e) / F.size(known))
    j = _with_static(j, thresholds.select(*by(thresholds), "threshold")).withColumn("score", score)
    flag = (F.col("score") > F.col("threshold")).cast("int")
    status = F.when((F.col("status") == "ok") & flag.isNull(), F.lit("no_validation")).otherwise(F.col("status"))
    return j.select("source", "ts", "event_id", "rn", *[f"err__{m}" for m in models], "x", "score", flag.alias("flag"),
                    status.alias("status"), "message")


def score_events(events: DataFrame, params, watermark: str = "1 hour", idle: str | None = None, max_ahead: str = "1 day") -> DataFrame:
    """Parsed events through the whole chain with ``flows.Params`` of a fit with one key (pooled or per series), as ``flows.score`` does in
    batch: the same phase, weights, kernel and learned models. The saved phase reads the time as ``ts``."""
    info = params.info
    if len(info["keys"]) != 1:
        raise ValueError("the stream needs parameters fitted with one key")
    key = info["keys"][0]
    by_source = lambda t: t.withColumnRenamed(key, "source") if key in t.columns else t
    feats, models, learned = info["feature_order"], info["models"], params.learned or {}
    rows = scale_stream(events, by_source(params.scaler), feats)
    if "seasonal" in models:
        rows = with_seasonal(rows, by_source(params.means), feats, params.phase())
    win = stateful_windows(rows, feats, info["window_size"], info["step_size"], info.get("weights", EWMA_WEIGHTS), watermark, models,
                           info.get("kernel", LOCAL_KERNEL), {name: m.window_errors for name, m in learned.items()}, idle, max_ahead)
    norms = by_source(params.normalizers) if params.normalizers is not None else None
    return score_stream(win, norms, by_source(params.thresholds), [*models, *learned])


def as_messages(df: DataFrame, key: str = "source") -> DataFrame:
    """A5: one JSON message per row, with its key, for a message sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def start(df: DataFrame, path: str | None, checkpoint: str, trigger: str | None = "5 seconds", fmt: str = "parquet",
          query_name: str | None = None, output_mode: str = "append", options: dict | None = None):
    """L1, A5: write a stream with a processing-time trigger and a checkpoint for exactly-once replay. ``options`` go to the
    sink (brokers and topic of a Kafka sink, whose rows come from ``as_messages``)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(processingTime=trigger)
    w = w.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start(path) if path else w.start()


def live_stats_sink(out_path: str, features: Sequence[str] = ()):
    """``foreachBatch`` with per-source live statistics of each scored micro-batch: J1 and J7, and with ``features`` J5 and
    J6 over the windows' last rows (aggregated on executors; a micro-batch is bounded by the trigger, so its percentiles are
    too). Written by ``write_batch``, so a batch that is run again changes nothing."""
    from seriesguard.operators import stats

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("score").isNotNull())
        out = rows.groupBy("source").agg(
            F.count(F.lit(1)).alias("n_windows"), F.avg("flag").alias("anomaly_rate"),
            F.percentile("score", 0.5).alias("error_median"), F.percentile("score", 0.95).alias("error_p95"))
        if features:
            wide = rows.select("source", *[F.col("x")[i].alias(c) for i, c in enumerate(features)])
            out = out.join(stats.live_stats(wide, ["source"], list(features), None), "source")
        write_batch(out, batch_id, out_path)
    return write


def write_batch(rows: DataFrame, batch_id: int, out_path: str) -> None:
    """A micro-batch's rows as the partition ``batch_id`` of a table. A batch that is replayed after a failure replaces its own
    partition, so it isn't counted twice, and the other partitions stay."""
    rows.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")


def table_sink(out_path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` that writes each micro-batch (after ``transform``) by ``write_batch``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch) if transform else batch, batch_id, out_path)
    return write


def metrics_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Metric samples from JSON files that appear in ``folder``, the last write of each label set (K2)."""
    schema = "metric string, feature string, model_version string, env string, ts timestamp, value double"
    return drift.metric_latest(spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).json(folder))


def health(query) -> dict:
    """Progress of a running query (rows in the last trigger, state rows)."""
    p = query.lastProgress or {}
    state = (p.get("stateOperators") or [{}])[0]
    return {"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"),
            "state_rows": state.get("numRowsTotal"), "name": p.get("name")}
