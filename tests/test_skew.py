"""One key holding a third of all rows: segment/block plans equal the whole-series plans."""

import math

import pytest
from pyspark.sql import functions as F

from seriesguard.operators import clean, recon, split, windows
from seriesguard.plans import layout

SF01 = "/root/testdata/sf0.01"
K = ["series_key"]


@pytest.fixture(scope="module")
def hot(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    v = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    return ev.select(key.alias("series_key"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
                     v.alias("v"), (F.col("user_id") * 1.0).alias("u")).cache()


def test_hot_key_is_a_third(hot):
    n = hot.count()
    assert hot.where("series_key = 'hot'").count() * 3 >= n - 3


def test_row_index_segments(hot):
    a = layout.row_index(hot, K, "ts", ["event_id"], rows_per_segment=500, max_rows=10**9)
    b = layout.row_index(hot, K, "ts", ["event_id"], max_rows=1)
    assert sorted(map(tuple, a.select("event_id", "rn", "n_rows").collect())) == \
        sorted(map(tuple, b.select("event_id", "rn", "n_rows").collect()))


def test_fill_blocks(hot):
    a = clean.fill_missing(hot, K, ["v"], tiebreak=["event_id"], rows_per_block=500, max_rows=10**9)
    b = clean.fill_missing(hot, K, ["v"], tiebreak=["event_id"], max_rows=1)
    assert sorted(map(tuple, a.select("event_id", "v").collect())) == sorted(map(tuple, b.select("event_id", "v").collect()))
    laid = layout.with_blocks(layout.row_index(hot, K, "ts", ["event_id"]), K, 1, rows_per_block=500)
    assert laid.where("series_key = 'hot'").select("_blk").distinct().count() > 5


def test_detectors_blocks(hot):
    sp = split.chrono_split(hot.where(F.col("v").isNotNull()), K, tiebreak=["event_id"])
    a = recon.detect(sp, K, ["v", "u"], 16, 1, rows_per_block=400, max_rows=10**9)
    b = recon.detect(sp, K, ["v", "u"], 16, 1, max_rows=1)
    da = {(r.series_key, r.ts, r.model): r.err for r in a.collect()}
    db = {(r.series_key, r.ts, r.model): r.err for r in b.collect()}
    assert da.keys() == db.keys() and len(da) > 3000
    assert all(math.isclose(da[k], db[k], rel_tol=1e-9, abs_tol=1e-12) for k in da)


def test_windows_blocks(hot):
    sp = split.chrono_split(hot.where(F.col("v").isNotNull()), K, tiebreak=["event_id"])
    a = windows.sliding_windows(sp, K, ["v"], 16, 2, rows_per_block=300, max_rows=10**9)
    b = windows.sliding_windows(sp, K, ["v"], 16, 2, max_rows=1)
    key = lambda d: sorted((r.series_key, r.ts, tuple(x[0] for x in r.win)) for r in d.collect())
    assert key(a) == key(b)


def test_alerts_of_a_huge_label_set_spread_over_blocks(spark):
    """One label set in many blocks: next samples, runs and states equal those of a single window."""
    import datetime as dt
    import random

    from seriesguard.operators import drift

    r = random.Random(2)
    t0, at, rows, high = dt.datetime(2024, 1, 1), 0, [], False
    for i in range(600):
        at += r.choice([5, 45, 90, 400])
        high = high ^ (r.random() < 0.08)
        rows.append(("anomaly_rate_live", "", "m" if i % 10 else "n", "prod", t0 + dt.timedelta(seconds=at), 0.5 if high else 0.0))
    rows += [("anomaly_rate_ref", "", v, "prod", t0, 0.01) for v in "mn"]
    samples = spark.createDataFrame(rows, "metric string, feature string, model_version string, env string, ts timestamp, value double")

    def states(**kw):
        conds = drift.evaluate_rules(drift.drift_intervals(samples, **kw), drift.rules_table(spark), samples=samples)
        return drift.alert_states(conds, **kw)

    whole, blocks = states(max_rows=600), states(rows_per_block=64)
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect())) and whole.count() > 20
    assert drift.alert_messages(blocks).count() > 3
