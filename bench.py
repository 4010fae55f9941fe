"""Benchmark: headline chains at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is forced to completion with the ``noop`` sink (no collect). Stage tables are rebuilt for
every query, so each time includes its whole chain from the parquet tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from seriesguard.operators import drift, profile, recon, windows  # noqa: E402
from seriesguard.plans import flows, panels, stages  # noqa: E402
from seriesguard.plans import queries as Q  # noqa: E402
from seriesguard.session import get_spark  # noqa: E402

KEYS = ["series_key"]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def q_prepare_window(spark, sf):
    """Clean -> split -> scale -> W=16 windows over every user series."""
    from seriesguard.operators import features, split
    from seriesguard.plans import layout
    p = flows.prepare(panels.user_series(spark, sf), KEYS, ["value"], tiebreak=["event_id"], resample=False)
    n_max = layout.max_series_rows(p, KEYS)
    sp = split.chrono_split(p, KEYS, max_rows=n_max)
    scaled = features.scaler_apply(sp, features.scaler_fit(sp, KEYS, ["value"]), KEYS, ["value"])
    return windows.sliding_windows(scaled, KEYS, ["value"], 16, 1, max_rows=n_max).select(
        "series_key", "ts", F.size("win").alias("n"))


def q_score_users(spark, sf):
    """Three detectors, z-score ensemble, validation threshold and flags over every user series.

    The series are short (45 to 99 rows), so normalisers and the threshold are pooled over all of them."""
    p = flows.prepare(panels.user_series(spark, sf), KEYS, ["value"], tiebreak=["event_id"], resample=False)
    flagged = flows.fit_score(p, KEYS, ["value"], W=16, pooled=True).flagged
    assert flagged.where("flag is not null").limit(1).count() == 1, "no scored windows"
    return flagged


def q_flagship(spark, sf):
    """Hourly event panel -> resample -> split -> scale -> detectors -> ensemble -> flags."""
    return Q.anomaly_flags(spark, sf)


def q_profile(spark, sf):
    """One-pass column profile and time-column detection."""
    prof = profile.profile_columns(panels.text_columns(spark, sf), "event_id", Q.P4_COLUMNS, now=Q.NOW)
    return profile.detect_time_column(prof, Q.P4_COLUMNS)


def q_drift_alerts(spark, sf):
    """Reference vs live statistics, as-of ticks, rule evaluation with hold times."""
    return Q.p1_rule_states(spark, sf)


def q_resample(spark, sf):
    """Daily order panel: frequency inference, irregularity and resampling."""
    return flows.prepare(panels.daily_orders(spark, sf), KEYS, panels.P3_FEATURES, checkpoint=False)


QUERIES = {"prepare_window": q_prepare_window, "score_users": q_score_users, "flagship": q_flagship,
           "profile_detect": q_profile, "drift_alerts": q_drift_alerts, "resample_orders": q_resample}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus))
    run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())  # JVM warm-up
    times = {}
    for name, fn in QUERIES.items():
        stages.clear(spark)
        t0 = time.time()
        run(fn(spark, sf))
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
                      "models": list(recon.MODELS), "rules": len(drift.RULES)}))
    spark.stop()


if __name__ == "__main__":
    main()
