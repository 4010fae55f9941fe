"""Frozen scoring, window counts and status rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesguard.operators import clean, ensemble, recon
from seriesguard.plans import flows

K = ["k"]
T0 = dt.datetime(2024, 1, 1)


def hourly(spark, n, series="a", features=2):
    cols = [F.sin(F.col("id") * (i + 1) / 7.0).alias(f"f{i}") for i in range(features)]
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    return spark.range(n).select(F.lit(series).alias("k"), ts.alias("ts"), *cols)


def test_recorded_window_counts_all_scored(spark):
    """15,000 rows give 9,585 / 2,385 / 2,985 scored windows."""
    fx = flows.fit_score(hourly(spark, 15_000), K, ["f0", "f1"])
    n = {r["split"]: r["n"] for r in fx.flagged.where("score is not null").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert n == {"train": 9585, "val": 2385, "test": 2985}
    assert fx.flagged.where("split = 'val' and flag = 1").count() == 24
    assert {r["n_models"] for r in fx.scores.select("n_models").distinct().collect()} == {3}


def test_short_input_scored_with_loaded_parameters(spark, tmp_path):
    panel = hourly(spark, 400)
    fx = flows.fit_score(panel, K, ["f0", "f1"])
    fx.params.save(str(tmp_path / "p"))
    params = flows.Params.load(spark, str(tmp_path / "p"))
    new = panel.orderBy("ts").limit(32).withColumn("extra", F.lit("x"))
    out = flows.score(new, params)
    assert out.count() == 17 and out.where("flag is null").count() == 0
    assert flows.score(panel.limit(10), params).count() == 0
    with pytest.raises(ValueError, match="missing required"):
        flows.score(new.drop("f1"), params)
    # frozen scoring of the test part equals the fitted run
    test = fx.split.where("split = 'test'").select("k", "ts", "f0", "f1")
    want = {r["ts"]: (r["score"], r["flag"]) for r in fx.flagged.where("split = 'test'").collect()}
    got = {r["ts"]: (r["score"], r["flag"]) for r in flows.score(test, params).collect()}
    assert got.keys() == want.keys() and all(abs(got[t][0] - want[t][0]) < 1e-9 and got[t][1] == want[t][1] for t in want)


def test_series_without_validation_windows_keeps_rows(spark):
    panel = hourly(spark, 400).unionByName(hourly(spark, 40, "short"))
    fx = flows.fit_score(panel, K, ["f0", "f1"])
    rows = fx.flagged.where("k = 'short'").collect()
    assert len(rows) == 26 - 15 and all(r["status"] == "no_validation" and r["flag"] is None for r in rows)
    assert fx.flagged.where("k = 'a' and status <> 'ok'").count() == 0
    pooled = flows.fit_score(panel, K, ["f0", "f1"], pooled=True)
    assert pooled.flagged.where("k = 'short' and status = 'ok'").count() == 11


def test_unseen_phase_averages_the_other_models(spark):
    fx = flows.fit_score(hourly(spark, 200), K, ["f0", "f1"], val_ratio=0.2, test_ratio=0.2)
    params = fx.params
    params.means = fx.means.where("_phase < 12")
    out = flows.score(hourly(spark, 48), params)
    assert out.count() == 33 and out.where("n_models = 2").count() > 0 and out.where("score is null").count() == 0


def test_ewma_renormalises_over_existing_lags(spark):
    df = hourly(spark, 20, features=1)
    errs = recon.detect(df, K, ["f0"], W=4, models=["ewma"])
    assert errs.count() == 17
    x = [r["f0"] for r in df.orderBy("ts").collect()]
    w = recon.EWMA_WEIGHTS

    def err(t):
        lags = [(w[k - 1], x[t - k]) for k in range(1, 5) if t - k >= 0]
        return (x[t] - sum(a * b for a, b in lags) / sum(a for a, _ in lags)) ** 2

    got = {r["rn_split"]: r["err"] for r in errs.collect()}
    assert got[3] == pytest.approx(sum(map(err, (1, 2, 3))) / 3) and got[9] == pytest.approx(sum(map(err, (6, 7, 8, 9))) / 4)
    with_null = df.withColumn("f0", F.when(F.hour("ts") != 8, F.col("f0")))
    assert recon.detect(with_null, K, ["f0"], W=4, models=["ewma"]).count() == 9  # windows with a null row or lag have no error


def test_array_timestep_errors(spark):
    df = spark.createDataFrame([("a", "t", T0, [[1.0, 2.0], [3.0, 4.0]], [[1.0, 0.0], [0.0, 4.0]])],
                               "k string, split string, ts timestamp, win array<array<double>>, recon array<array<double>>")
    got = [(r["pos"], r["err"]) for r in ensemble.err_timesteps_arrays(df, K).orderBy("pos").collect()]
    assert got == [(0, 2.0), (1, 4.5)]


def test_prepare_options(spark):
    rows = [("a", T0, 0.0), ("a", T0 + dt.timedelta(hours=1), None), ("a", T0 + dt.timedelta(hours=2), 4.0), ("a", T0, 9.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    timed = flows.prepare(df, K, ["v"], fill="time", resample=False)
    assert [r["v"] for r in timed.orderBy("ts").collect()] == [0.0, 2.0, 4.0]
    assert flows.prepare(df, K, ["v"], raw_order=True).count() == 4
    with pytest.raises(ValueError, match="unknown fill"):
        flows.prepare(df, K, ["v"], fill="spline")


def test_dedup_without_tiebreak_is_deterministic(spark):
    rows = [("a", T0, float(i), str(i)) for i in (5, 3, 9)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double, s string")
    for n in (1, 3):
        assert clean.dedup_first(df.repartition(n), K).first()["v"] == 3.0


def test_phase_given_as_a_column_must_be_passed_again(spark):
    panel = hourly(spark, 200)
    params = flows.fit_score(panel, K, ["f0", "f1"], phase=F.dayofweek("ts")).params
    with pytest.raises(ValueError, match="phase of its own"):
        flows.score(panel, params)
    assert flows.score(panel, params, phase="dayofweek(ts)").count() == 185


def test_flag_summary_of_unjudged_and_missing_series(spark):
    from seriesguard.operators import drift, runs

    rows = [("a", 1), ("a", 0), ("b", 0), ("c", None), ("c", None)]
    flagged = spark.createDataFrame(rows, "k string, flag int")
    series = spark.createDataFrame([(k,) for k in "abcd" for _ in range(2)], "k string")
    got = {r.k: (r.n_flagged, r.n_windows, r.message) for r in runs.flag_summary(flagged, K, series).collect()}
    assert got == {"a": (1, 2, "OK"), "b": (0, 1, "No anomalies detected"), "c": (None, 2, "No threshold to judge by"),
                   "d": (None, 0, "Not enough rows for one window")}
    keys = [("a/b", "c"), ("a", "b/c"), ("a\\", "/b"), ("a\\/", "b"), (None, "x"), ("null", "x"), ("\\N", "x"), ("a", "b")]
    labels = [r.model_version for r in spark.createDataFrame(keys, "p string, q string").select(drift._version(["p", "q"])).collect()]
    assert len(set(labels)) == len(keys) and labels[-1] == "a/b"


def test_meta_record_of_a_pooled_fit(spark):
    """One record; with one series it equals the record of that series."""
    from seriesguard.operators import stats

    one = hourly(spark, 300)
    cols = ["threshold", "error_stats", "anomaly_rate_ref", "feature_stats", "normalizers"]
    def flat(r):
        return [r.threshold, *r.error_stats, r.anomaly_rate_ref, *r.feature_stats["mean"], *r.feature_stats["std"], r.feature_stats["global_mean"],
                r.feature_stats["global_std"], *(x for m in sorted(r.normalizers) for x in r.normalizers[m])]

    own = stats.meta_record(flows.fit_score(one, K, ["f0", "f1"]), K, ["f0", "f1"]).select(*cols).collect()
    pooled = stats.meta_record(flows.fit_score(one, K, ["f0", "f1"], pooled=True), K, ["f0", "f1"])
    assert "k" not in pooled.columns
    pooled = pooled.select(*cols).collect()
    assert len(own) == len(pooled) == 1 and flat(pooled[0]) == pytest.approx(flat(own[0]), rel=1e-9)
    fx = flows.fit_score(one.unionByName(hourly(spark, 200, "b")), K, ["f0", "f1"], pooled=True)
    both = stats.meta_record(fx, K, ["f0", "f1"]).collect()
    assert len(both) == 1 and both[0].threshold == fx.thresholds.first().threshold
