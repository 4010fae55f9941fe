"""Alerts on a stream of samples equal the batch messages, however the samples are cut into files."""

import datetime as dt
import json
import os
import random
import tempfile
import time

import pytest

from seriesguard.operators import drift
from seriesguard.streaming import alerts
from seriesguard.streaming import stream as S

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "metric string, feature string, model_version string, env string, ts timestamp, value double"


def samples(seed=4):
    """References, and gauges that cross their limits now and then, some for long enough."""
    r = random.Random(seed)
    ref, live = [], []
    for v in ("m1", "m2"):
        for metric, value in (("error_median", 1.0), ("error_p95", 2.0), ("anomaly_rate", 0.01)):
            ref.append((metric + "_ref", "", v, "prod", T0, value))
        for f in ("a", "b"):
            ref.append(("feature_mean_ref", f, v, "prod", T0, 0.0))
        level = dict.fromkeys(["error_median", "error_p95", "anomaly_rate", "a", "b"], False)
        at = 0.0
        for _ in range(150):
            at += r.choice([7, 40, 95, 200, 600])
            ts = T0 + dt.timedelta(seconds=at, microseconds=r.randrange(10) * 100_000)
            for name in level:
                if r.random() < 0.15:
                    level[name] = not level[name]
                if r.random() < 0.2:
                    continue
                high = level[name]
                if name in ("a", "b"):
                    live.append(("feature_mean_live", name, v, "prod", ts, 0.9 if high else 0.1))
                else:
                    live.append((name + "_live", "", v, "prod", ts, {"error_median": 3.0, "error_p95": 5.0, "anomaly_rate": 0.2}[name] if high else 0.0))
    live.append(("feature_std_live", "a", "m1", "prod", max(x[4] for x in live) + dt.timedelta(hours=2), 1.0))  # only shows that time passes
    return ref, sorted(live, key=lambda x: x[4])


def folder_of(rows, n_files):
    folder = tempfile.mkdtemp(prefix="sg-alerts-")
    for i in range(n_files):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as f:
            for m, feature, v, env, ts, value in rows[i * len(rows) // n_files:(i + 1) * len(rows) // n_files]:
                f.write(json.dumps({"metric": m, "feature": feature, "model_version": v, "env": env, "ts": ts.isoformat(), "value": value}) + "\n")
        t = time.time() - 10_000 + i * 10
        os.utime(p, (t, t))
    return folder


def start(spark, folder, ref, **kw):
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    name = f"alerts_{time.time_ns()}"
    out = alerts.alert_stream(raw, spark.createDataFrame(ref, SCHEMA), **kw)
    return S.start(out, None, tempfile.mkdtemp(prefix="sg-ckpt-"), trigger=None, fmt="memory", query_name=name), name


COLUMNS = ["alert", "feature", "model_version", "env", "severity", "active_since", "fired_at", "message"]


@pytest.mark.parametrize("n_files", [1, 6])
def test_stream_messages_equal_batch(spark, n_files):
    ref, live = samples()
    table = spark.createDataFrame(ref + live, SCHEMA)
    conds = drift.evaluate_rules(drift.drift_intervals(table), drift.rules_table(spark), samples=table)
    want = drift.alert_messages(drift.alert_states(conds)).select(*COLUMNS)
    query, name = start(spark, folder_of(live, n_files), ref)
    query.processAllAvailable()
    query.stop()
    got = spark.table(name)
    assert got.where("status <> 'firing'").count() == 0
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(map(tuple, want.collect())) and want.count() > 20


def test_late_samples_come_out_and_a_live_alert_fires_by_the_clock(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ref = [("anomaly_rate_ref", "", "m", "prod", T0, 0.01)]
    old = now - dt.timedelta(seconds=620)
    live = [("anomaly_rate_live", "", "m", "prod", old, 0.5), ("anomaly_rate_live", "", "m", "prod", old - dt.timedelta(hours=1), 0.0)]
    query, name = start(spark, folder_of(live, 2), ref, live=True)
    end = time.time() + 90
    while time.time() < end and query.exception() is None and spark.table(name).count() < 2:
        time.sleep(1)
    query.stop()
    rows = {r.status: r for r in spark.table(name).collect()}
    assert set(rows) == {"firing", "late"} and rows["firing"].alert == "AnomalyRateSpike"
    assert rows["firing"].fired_at - rows["firing"].active_since == dt.timedelta(seconds=600) and rows["late"].fired_at == old - dt.timedelta(hours=1)
