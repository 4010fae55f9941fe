"""Unit tests on small hand-made frames with hand-computed answers (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesguard.functions.quantiles import group_quantile
from seriesguard.operators import clean, drift, ensemble, features, grid, profile, runs, split, stats, windows
from seriesguard.plans import layout

K = ["k"]


def ts(h, m=0, s=0, day=1):
    return dt.datetime(2024, 1, day, h, m, s)


def frame(spark, rows, schema="k string, ts timestamp, v double"):
    return spark.createDataFrame(rows, schema)


def test_anchor_hourly_resample(spark):
    df = frame(spark, [("a", ts(10, 0, 30), 1.0), ("a", ts(11, 0, 30), 2.0), ("a", ts(12, 0, 30), 3.0),
                       ("a", ts(14, 0, 30), 4.0)])
    out = grid.resample_ffill(df, K, ["v"], only_irregular=False)
    got = {r.ts.hour: r.v for r in out.collect()}
    assert got == {11: 1.0, 12: 2.0, 13: 3.0, 14: 3.0}
    lead = grid.resample_ffill(df, K, ["v"], only_irregular=False, keep_leading=True).collect()
    assert {r.ts.hour: r.v for r in lead}[10] is None


def test_anchor_seven_hour_grid(spark):
    # steps 7h, 8h, 6h: each seen once, so the first seen (7h) is the grid step
    rows = frame(spark, [("a", ts(0, 0, 0, day=2), 0.0), ("a", ts(7, 0, 0, day=2), 1.0),
                         ("a", ts(15, 0, 0, day=2), 2.0), ("a", ts(21, 0, 0, day=2), 3.0)])
    out = {(r.ts.hour): r.v for r in grid.resample_ffill(rows, K, ["v"], only_irregular=False).collect()}
    # modal step 7h (first seen among 7h, 8h, 6h ties); grid from midnight: 0, 7, 14, 21
    assert out == {0: 0.0, 7: 1.0, 14: 1.0, 21: 3.0}


def test_modal_delta_first_seen_wins(spark):
    def series(key, deltas):
        t, rows = dt.datetime(2024, 1, 1), [(key, dt.datetime(2024, 1, 1), 0.0)]
        for d in deltas:
            t = t + dt.timedelta(seconds=d)
            rows.append((key, t, 0.0))
        return rows
    df = frame(spark, series("a", [5, 3, 3, 5]) + series("b", [3, 5, 5, 3]))
    got = {r.k: r.delta_us // 1_000_000 for r in grid.modal_delta(df, K).collect()}
    assert got == {"a": 5, "b": 3}


def test_month_starts_are_calendar_not_irregular(spark):
    df = frame(spark, [("a", dt.datetime(2024, m, 1), 1.0) for m in (1, 2, 3, 4)])
    r = grid.irregularity(df, K).collect()[0]
    assert r.freq_kind == "month" and r.is_irregular is False


def test_fills(spark):
    rows = [("a", ts(h), v) for h, v in enumerate([None, 1.0, None, None, 4.0, None])]
    df = frame(spark, rows)
    f = {r.ts.hour: r.v for r in clean.fill_missing(df, K, ["v"], rows_per_block=2).collect()}
    assert f == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0, 4: 4.0, 5: 4.0}
    i = {r.ts.hour: r.v for r in clean.interpolate_time(df, K, ["v"], rows_per_block=2).collect()}
    assert i == {0: 1.0, 1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 4.0}
    allnull = frame(spark, [("a", ts(h), None) for h in range(3)])
    assert all(r.v is None for r in clean.fill_missing(allnull, K, ["v"]).collect())


def test_dedup_first_keeps_lowest_tiebreak(spark):
    df = spark.createDataFrame([("a", ts(1), 2.0, 1), ("a", ts(1), 1.0, 0), ("a", ts(2), 3.0, 0)],
                               "k string, ts timestamp, v double, tie int")
    got = sorted((r.ts.hour, r.v) for r in clean.dedup_first(df, K, "ts", ["tie"]).collect())
    assert got == [(1, 1.0), (2, 3.0)]


@pytest.mark.parametrize("n,expected", [(9, (7, 1, 1)), (15000, (9600, 2400, 3000))])
def test_split_sizes(spark, n, expected):
    df = spark.range(n).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("ts"))
    got = {r.split: r["count"] for r in split.chrono_split(df, K).groupBy("split").count().collect()}
    assert (got.get("train"), got.get("val"), got.get("test")) == expected


def test_row_index_segments_equal_row_number(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("k"),
                                 F.timestamp_seconds((F.col("id") * 7919) % 1000).alias("ts"), "id")
    a = layout.row_index(df, K, "ts", ["id"], rows_per_segment=16)
    b = layout.row_index(df, K, "ts", ["id"], rows_per_segment=1 << 20)
    assert sorted(map(tuple, a.select("id", "rn").collect())) == sorted(map(tuple, b.select("id", "rn").collect()))


@pytest.mark.parametrize("T,step,expected", [(15, 1, 0), (16, 1, 1), (17, 1, 2), (20, 1, 5),
                                             (15, 4, 0), (16, 4, 1), (17, 4, 1), (20, 4, 2)])
def test_window_edges(spark, T, step, expected):
    df = spark.range(T).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("ts"),
                               F.col("id").cast("double").alias("v"))
    win = windows.sliding_windows(df, K, ["v"], 16, step, rows_per_block=16)
    assert win.count() == expected
    assert windows.short_series(df, K, 16, step).collect()[0].n_windows == expected


def test_halo_windows_equal_plain(spark):
    df = spark.range(300).select((F.col("id") % 2).cast("string").alias("k"), F.timestamp_seconds("id").alias("ts"),
                                 F.sin("id").alias("v"))
    a = windows.sliding_windows(df, K, ["v"], 16, 3, rows_per_block=20)
    b = windows.sliding_windows(df, K, ["v"], 16, 3)
    key = lambda d: sorted((r.k, r.ts, tuple(x[0] for x in r.win)) for r in d.collect())
    assert key(a) == key(b)


def test_coverage_weights_brute_force(spark):
    T, W, step = 23, 5, 2
    starts = range(0, T - W + 1, step)
    brute = [sum(1 for s in starts if s <= i < s + W) for i in range(T)]
    df = spark.range(T).select(F.col("id").alias("i"))
    got = [int(r.w) for r in df.select(stats.coverage_weight(F.col("i"), F.lit(T), W, step).alias("w")).collect()]
    assert got == brute


def test_const_feature_scale_and_ref_std(spark):
    df = spark.range(40).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("ts"),
                                F.lit(3.0).alias("c"), F.col("id").cast("double").alias("x"))
    sp = split.chrono_split(df, K)
    fit = features.scaler_fit(sp, K, ["c", "x"])
    scaled = features.scaler_apply(sp, fit, K, ["c", "x"])
    assert {r.c for r in scaled.collect()} == {0.0}
    fs = {r.feature: r.std for r in stats.feature_stats_ref(scaled, K, ["c", "x"], W=16).collect()}
    assert fs["c"] == pytest.approx(1e-6)


def test_q99_flags_24_of_2385(spark):
    df = spark.range(2385).select(F.lit("a").alias("k"), F.lit("val").alias("split"),
                                  F.col("id").cast("double").alias("score"))
    thr = ensemble.threshold_fit(df, K, "quantile", 0.99)
    fl = ensemble.flags(df, thr, K)
    rate = stats.anomaly_rate(fl, K).collect()[0].anomaly_rate
    assert fl.where("flag = 1").count() == 24
    assert rate == pytest.approx(0.010062893081761006)


def test_quantiles_of_any_shape_through_the_rounds(spark):
    import random

    from seriesguard.functions.quantiles import group_quantiles
    rnd = random.Random(3)
    shapes = {"zero_one": [0.0] * 20 + [1.0] * 20, "clusters": [rnd.random() * 1e-9 for _ in range(600)] + [1 + rnd.random() * 1e-9 for _ in range(600)],
              "runs": [5.0] * 300 + [7.0] * 300 + [float(i) for i in range(100)], "constant": [2.5] * 200, "one": [4.0],
              "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-300] * 30 + [float(i) for i in range(50)], "tiny": [0.0, 5e-324] * 60,
              "exponents": [10.0 ** rnd.randint(-200, 200) for _ in range(400)]}
    rows = [(g, x) for g, xs in shapes.items() for x in xs] + [("runs", None), ("runs", float("nan"))]
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r.g: r for r in group_quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", qs, small=3, bins=4).collect()}
    for g, xs in shapes.items():
        xs = sorted(xs)
        for name, v in qs.items():
            h = (len(xs) - 1) * v
            lo, hi = xs[int(h)], xs[min(int(h) + 1, len(xs) - 1)]
            want = lo if h == int(h) else lo + (hi - lo) * (h - int(h))
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=0.0), (g, name)


def test_recorded_flag_rate_through_the_rounds(spark):
    """24 of 2,385 scores exceed their own 0.99 quantile."""
    df = spark.range(2385).select(F.lit("s").alias("k"), (F.col("id") * F.col("id")).cast("double").alias("x"))
    thr = group_quantile(df, ["k"], "x", 0.99, small=10, bins=8).first()["quantile"]
    assert df.where(F.col("x") > thr).count() == 24


def test_quantile_narrowing_equals_exact(spark):
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), F.sin(F.col("id") * 1.7).alias("x"))
    got = {r.g: r.quantile for r in group_quantile(df, ["g"], "x", 0.37, small=500, bins=64).collect()}
    exact = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("x", 0.37).alias("p")).collect()}
    assert got.keys() == exact.keys()
    assert all(got[g] == pytest.approx(exact[g], abs=1e-12) for g in got)


def test_option_checks(spark):
    df = spark.createDataFrame([("a", "val", "ts", 1, "m", 1.0)], "k string, split string, ts string, rn_split int, "
                               "model string, err double")
    with pytest.raises(ValueError):
        ensemble.ensemble(df, K, "bogus")
    with pytest.raises(ValueError):
        ensemble.ensemble(df, K, "zscore", None)
    with pytest.raises(ValueError):
        ensemble.threshold_fit(df, K, "bogus")
    with pytest.raises(ValueError):
        ensemble.ensemble(df, K, "none", None, models=[])


def _rule_states(spark, base, live_ref_rows, mode="guarded"):
    rows = [(base, "", "m", "prod", t, live, ref) for t, live, ref in live_ref_rows]
    pairs = spark.createDataFrame(rows, "base string, feature string, model_version string, env string, "
                                  "ts timestamp, live double, ref double")
    return drift.evaluate_rules(pairs, drift.rules_table(spark), mode)


def test_negative_reference_median(spark):
    rows = []
    for i, (med_live, p95_live) in enumerate([(-0.30, 0.0), (2.00, 0.0)]):
        t = ts(0, i)
        rows += [("error_median", "", "m", "prod", t, med_live, -0.137), ("error_p95", "", "m", "prod", t, p95_live, 1.654)]
    pairs = spark.createDataFrame(rows, "base string, feature string, model_version string, env string, "
                                  "ts timestamp, live double, ref double")
    def fired(mode):
        c = drift.evaluate_rules(pairs, drift.rules_table(spark), mode)
        return sorted(r.live for r in c.where("alert = 'EnsembleErrorMedianHigh' AND active").collect())
    assert fired("ratio") == [-0.30]
    assert fired("guarded") == [2.00]


def test_hold_time(spark):
    pattern = [True] * 9 + [False] + [True] * 11
    rows = [("AnomalyRateSpike", "", "m", "prod", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=30 * i),
             1.0, 0.1, a, 300, "critical", "s") for i, a in enumerate(pattern)]
    conds = spark.createDataFrame(rows, "alert string, feature string, model_version string, env string, ts timestamp,"
                                  " live double, ref double, active boolean, hold_s int, severity string, summary string")
    st = sorted(drift.alert_states(conds).collect(), key=lambda r: r.from_ts)
    assert [(r.state, r.n_ticks) for r in st] == [("pending", 9), ("inactive", 1), ("pending", 10), ("firing", 1)]
    assert st[3].from_ts == dt.datetime(2024, 1, 1) + dt.timedelta(seconds=30 * 20)


def test_holds_of_five_and_ten_minutes_differ(spark):
    """A condition that holds for 8 minutes between two samples fires with a 5 minute hold only."""
    t0 = dt.datetime(2024, 1, 1)
    live = [(m, "", "m", "prod", t0 + dt.timedelta(minutes=i), v) for m in ("error_median_live", "anomaly_rate_live")
            for i, v in ((0, 0.1), (10, 0.9), (18, 0.1), (30, 0.1))]
    ref = [(m, "", "m", "prod", t0, 0.2) for m in ("error_median_ref", "anomaly_rate_ref")] + [("error_p95_ref", "", "m", "prod", t0, 0.3)]
    samples = spark.createDataFrame(live + ref, "metric string, feature string, model_version string, env string, ts timestamp, value double")
    conds = drift.evaluate_rules(drift.drift_intervals(samples), drift.rules_table(spark), samples=samples)
    fired = drift.alert_messages(drift.alert_states(conds)).collect()
    assert [(r.alert, r.active_since, r.fired_at) for r in fired] == [
        ("EnsembleErrorMedianHigh", t0 + dt.timedelta(minutes=10), t0 + dt.timedelta(minutes=15))]
    ticks = drift.metric_asof(samples).where("metric = 'error_median_live'").orderBy("ts").collect()
    assert len(ticks) == 61 and ticks[19].value == 0.1 and ticks[20].value == 0.9 and ticks[36].value == 0.1
    old = drift.metric_asof(samples, lookback_us=60_000_000).where("metric = 'error_median_live'").count()
    assert old == 3 + 3 + 3 + 1


def test_metric_samples_scan_few_tables(spark, tmp_path):
    """The samples are aggregates over the fitted tables, each scanned a few times."""
    from seriesguard.plans import flows
    df = spark.range(300).select(F.lit("a").alias("k"), (F.col("id") % 2).alias("h"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"),
                                 F.sin("id").alias("v"))
    fx = flows.fit_score(df, ["k", "h"], ["v"], W=8)
    samples = drift.metric_samples(fx, ["k", "h"], ["v"])
    plan = samples._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 6
    assert {r[0] for r in samples.select("model_version").distinct().collect()} == {"a/0", "a/1"}


def test_sparse_series_is_rejected_and_others_go_on(spark):
    rows = [("sparse", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), float(s)) for s in (0, 1, 2, 100_000)]
    rows += [("good", ts(h), float(h)) for h in (0, 1, 2, 5)]
    df = frame(spark, rows)
    verdicts = {r.k: r for r in grid.grid_verdicts(df, K).collect()}
    assert verdicts["good"].valid and not verdicts["sparse"].valid and "100001 points for 4 rows" in verdicts["sparse"].reason
    out = grid.resample_ffill(df, K, ["v"])
    assert {r.k for r in out.collect()} == {"good"} and out.count() == 6
    assert {r.k for r in grid.expected_grid(df, K).select("k").distinct().collect()} == {"good"}
    valid, rejected = runs.route(df, grid.grid_verdicts(df, K), K)
    assert valid.count() == 4 and [r.k for r in rejected.collect()] == ["sparse"]


def test_given_step_on_a_regular_series(spark):
    df = frame(spark, [("a", ts(h), float(h)) for h in range(10)])
    out = grid.resample_ffill(df, K, ["v"], freq_us=1_800_000_000).orderBy("ts").collect()
    assert len(out) == 19 and [r.v for r in out[:4]] == [0.0, 0.0, 1.0, 1.0]
    assert grid.resample_ffill(df, K, ["v"], freq_us=3_600_000_000).count() == 10


def test_long_gap_is_exploded_in_chunks(spark):
    df = frame(spark, [("a", ts(0), 1.0), ("a", ts(0, 0, 1), 2.0), ("a", ts(3), 3.0), ("a", ts(3, 0, 1), 4.0)])
    out = grid.resample_ffill(df, K, ["v"], max_grid_ratio=1e6)
    assert out.count() == 10_802 and out.where("v = 2").count() == 10_799


def test_row_index_segments_stay_near_the_target(spark):
    """An outlier, a burst and half of all rows at one time: no segment holds more than twice the target."""
    n, target = 6000, 200
    t = (F.when(F.col("id") == 5, F.lit(0)).when(F.col("id") % 2 == 0, F.lit(1_700_000_000)).when(F.col("id") < 3000, 1_600_000_000 + F.col("id") % 7)
         .otherwise(F.col("id") * 1000))
    df = spark.range(n).select(F.lit("s").alias("k"), F.timestamp_seconds(t).alias("ts"), "id")
    out = layout.row_index(df, K, "ts", ["id"], rows_per_segment=target)
    got = [(r.rn, r.n_rows) for r in out.orderBy("ts", "id").collect()]
    assert got == [(i, n) for i in range(n)]
    sizes = spark.read.parquet(*out.inputFiles()).groupBy("_seg").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * target and len(sizes) >= n / target


def test_row_index_small_segments_share_range_partitions(spark):
    """Range partitions, whose samples and files the driver gets, don't follow the number of segments; null keys are a series."""
    n, target = 6000, 16
    key = F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string"))
    df = spark.range(n).select(key.alias("k"), F.timestamp_seconds(F.col("id") * 7919 % n).alias("ts"), "id")
    out = layout.row_index(df, K, "ts", ["id"], rows_per_segment=target)
    whole = layout.row_index(df, K, "ts", ["id"], max_rows=1)
    assert out.count() == n and out.exceptAll(whole.select(*out.columns)).isEmpty()
    sizes = spark.read.parquet(*out.inputFiles()).groupBy("_seg").count().collect()
    assert max(r["count"] for r in sizes) <= target and sum(r["count"] for r in sizes) == n
    assert len(set(out.inputFiles())) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_share_80_gate_strict_detector_inclusive(spark):
    vals = ["2024-01-0%d" % (i % 9 + 1) for i in range(8)] + ["junk", "junk"]
    df = spark.createDataFrame([(i, v, float(i)) for i, v in enumerate(vals)], "o long, s string, x double")
    prof = profile.profile_columns(df, "o", ["s", "x"], now="2025-01-01 00:00:00")
    p = {r.column: r for r in profile.plausible(prof).collect()}
    assert p["s"].parse_ratio == pytest.approx(0.8) and p["s"].is_time_column is False
    pick = profile.detect_time_column(prof, ["s", "x"], candidates=["s"]).collect()[0]
    assert pick.column == "s" and pick.stage == "candidate"


def test_epoch_units(spark):
    base = 1_704_067_200
    df = spark.createDataFrame([(i, float(base + 3600 * i), float((base + 3600 * i) * 1000)) for i in range(20)],
                               "o long, sec double, ms double")
    prof = profile.profile_columns(df, "o", ["sec", "ms"], now="2025-01-01 00:00:00")
    units = {r.column: r.unit for r in profile.detect_scores(prof).collect()}
    assert units == {"sec": "s", "ms": "ms"}
    c = clean.coerce_ts(df, "ms", unit="ms", out="t").collect()[0].t
    assert c == dt.datetime(2024, 1, 1)


def test_unsorted_strings_detected_without_bonus(spark):
    vals = ["2024-01-03", "2024-01-01", "2024-01-02", "2024-01-05", "2024-01-04"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "o long, s string")
    prof = profile.profile_columns(df, "o", ["s"], now="2025-01-01 00:00:00")
    r = prof.collect()[0]
    assert r.mono_t is False
    assert profile.detect_scores(prof).collect()[0].score == pytest.approx(1.2)


def test_best_step_ties_go_earliest(spark):
    log = spark.createDataFrame([("r", "loss", 1, 0.5), ("r", "loss", 2, 0.3), ("r", "loss", 3, 0.3)],
                                "run_id string, key string, step int, value double")
    r = runs.best_step(log).collect()[0]
    assert (r.best_step, r.best_value) == (2, 0.3)


def test_flag_summary_messages(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1)], "k string, flag int")
    got = {r.k: r.message for r in runs.flag_summary(df, K).collect()}
    assert got == {"a": "No anomalies detected", "b": "OK"}


def test_required_columns_checked_at_plan_time(spark):
    df = frame(spark, [("a", ts(1), 1.0)])
    with pytest.raises(ValueError, match="missing required columns"):
        features.enforce_contract(df, ["v", "w"], "ts")
    assert features.enforce_contract(df, ["v"], "ts").columns == ["ts", "v"]


def test_business_day_frequency(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 15)]  # Mon..Fri, Mon..Fri, Mon
    df = frame(spark, [("a", d, 1.0) for d in days])
    r = grid.infer_freq(df, K).collect()[0]
    assert r.freq_kind == "business_day"
    assert grid.irregularity(df, K).collect()[0].is_irregular is False


def test_run_log_rows(spark):
    hist = spark.createDataFrame([(1, 0.5), (2, 0.4)], "epoch int, val_loss double")
    log = runs.log_metrics(hist, "run-1", "epoch", "epoch", "val_loss").withColumn("key", F.lit("val_loss"))
    assert [tuple(r) for r in log.orderBy("step").collect()] == [("run-1", "val_loss", 1, 0.5),
                                                                 ("run-1", "val_loss", 2, 0.4)]


def test_anchor_seven_hour_fixture(spark):
    df = frame(spark, [("a", ts(10, 0, 30), 1.0), ("a", ts(11, 0, 30), 2.0), ("a", ts(12, 0, 30), 3.0),
                       ("a", ts(14, 0, 30), 4.0)])
    seven = 7 * 3600 * 1_000_000
    got = {r.ts.hour: r.v for r in grid.resample_ffill(df, K, ["v"], only_irregular=False, freq_us=seven,
                                                        keep_leading=True).collect()}
    assert got == {7: None, 14: 3.0}
    assert {r.ts.hour: r.v for r in grid.resample_ffill(df, K, ["v"], only_irregular=False,
                                                         freq_us=seven).collect()} == {14: 3.0}


def test_pooled_threshold_and_scaler(spark):
    df = spark.range(2385).select(F.lit("a").alias("k"), F.lit("val").alias("split"),
                                  F.col("id").cast("double").alias("score"))
    thr = ensemble.threshold_fit(df, K, "quantile", 0.99, pooled=True)
    assert ensemble.flags(df, thr, K, pooled=True).where("flag = 1").count() == 24
    rows = spark.createDataFrame([("a", "train", 1.0), ("b", "train", 3.0)], "k string, split string, x double")
    fit = features.scaler_fit(rows, K, ["x"], pooled=True)
    assert sorted(r.x for r in features.scaler_apply(rows, fit, K, ["x"], pooled=True).collect()) == [-1.0, 1.0]
