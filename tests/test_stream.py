"""Stream = batch: windows scored across micro-batches equal the batch windows."""

import datetime as dt
import json
import math
import os
import random
import tempfile
import time

from pyspark.sql import functions as F

from seriesguard.operators import recon
from seriesguard.plans import flows, panels
from seriesguard.streaming import stream as S
from tests.conftest import SF

FEATS = ["value", "user"]
DELAY = "1 hour"


def _messages(spark):
    out = []
    for r in panels.events(spark, SF).orderBy("ts", "event_id").collect():
        out.append({"event_id": r.event_id, "ts": r.ts.strftime("%Y-%m-%dT%H:%M:%S.%f"), "source": r.event_type,
                    "value": r.value, "user": float(r.user_id)})
    return out


def _write(lines, n_files):
    """``lines`` in order over ``n_files`` files with increasing times."""
    folder = tempfile.mkdtemp(prefix="sg-stream-in-")
    for i in range(n_files):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines[i * len(lines) // n_files:(i + 1) * len(lines) // n_files]) + "\n")
        t = time.time() - 10_000 + i * 10
        os.utime(p, (t, t))
    return folder


def _run(spark, lines, n_files, build):
    """Rows of the memory table that ``build(raw stream)`` was written to."""
    raw = S.read_event_stream(spark, _write(lines, n_files), max_files_per_trigger=1)
    name = f"out_{time.time_ns()}"
    query = S.start(build(raw), None, tempfile.mkdtemp(prefix="sg-ckpt-"), trigger=None, fmt="memory", query_name=name)
    query.processAllAvailable()
    query.stop()
    return spark.table(name)


def _ewma(features=FEATS, **kw):
    return lambda raw: S.stateful_windows(S.parse_stream(raw, features)[0], features, W=16, watermark=DELAY, **kw)


def _batch(spark):
    """Window errors by source and time, of windows that the watermark has passed."""
    ev = panels.events(spark, SF).select(F.col("event_type").alias("series_key"), "ts", "event_id",
                                         F.col("value").cast("double").alias("value"),
                                         F.col("user_id").cast("double").alias("user"))
    errs = recon.detect(ev, ["series_key"], FEATS, 16, 1, ["ewma"])
    newest = ev.groupBy("series_key").agg(F.max("ts").alias("newest"))
    passed = errs.join(newest, "series_key").where(F.col("ts") <= F.col("newest") - F.expr("interval 1 hour"))
    return {(r.series_key, r.ts): r.err for r in passed.collect()}


def _errors(out):
    return {(r.source, r.ts): r.err__ewma for r in out.where("status = 'ok'").collect()}


def _equal(got, want):
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)


def test_stream_equals_batch_for_file_splits(spark):
    want = _batch(spark)
    assert len(want) > 900
    lines = [json.dumps(m) for m in _messages(spark)]
    for n in (1, 3, 7):
        _equal(_errors(_run(spark, lines, n, _ewma())), want)


def _disordered(messages, seconds, seed=1):
    """The messages in the order of their times plus up to ``seconds``."""
    rnd = random.Random(seed)
    at = lambda m: dt.datetime.fromisoformat(m["ts"]).timestamp()
    return sorted(messages, key=lambda m: at(m) + rnd.uniform(0, seconds))


def test_disorder_within_the_watermark_changes_nothing(spark):
    shuffled = _disordered(_messages(spark), 3500)
    assert [m["event_id"] for m in shuffled] != [m["event_id"] for m in _messages(spark)]
    out = _run(spark, [json.dumps(m) for m in shuffled], 5, _ewma())
    _equal(_errors(out), _batch(spark))
    assert out.where("status <> 'ok'").count() == 0


def test_late_and_repeated_rows_are_routed(spark):
    messages = _messages(spark)
    old = [dict(messages[10], event_id=90_000, ts="2020-01-01T00:00:00.000000"), messages[20]]
    out = _run(spark, [json.dumps(m) for m in [*messages, *old]], 4, _ewma())
    assert sorted(r.event_id for r in out.where("status = 'late'").collect()) == sorted([90_000, messages[20]["event_id"]])
    _equal(_errors(out), _batch(spark))


def test_bad_messages_and_features_are_rejected_and_do_not_shift_windows(spark):
    messages = _messages(spark)
    lines = [json.dumps(m) for m in messages]
    first = messages[0]
    bad = ["{bad", "[1, 2]", json.dumps(dict(first, ts="not-a-time")), json.dumps(dict(first, value=None)), json.dumps(dict(first, value="high")),
           json.dumps({k: v for k, v in first.items() if k != "user"}), json.dumps({k: v for k, v in first.items() if k != "ts"})]
    mixed = [x for i, line in enumerate(lines) for x in ([line, bad[i // 100]] if i % 100 == 50 and i // 100 < len(bad) else [line])]
    out = _run(spark, mixed, 3, _ewma())
    _equal(_errors(out), _batch(spark))
    rejected = S.parse_stream(spark.createDataFrame([(x,) for x in bad], "value string"), FEATS)[1]
    assert sorted(r.reason for r in rejected.collect()) == ["bad time", "bad:value", "malformed", "malformed", "missing:ts", "missing:user",
                                                            "missing:value"]


def test_other_feature_names_flat_and_nested(spark):
    names = ["oil temp", "p.1"]
    lines = []
    for i, m in enumerate(_messages(spark)):
        body = {names[0]: m["value"], names[1]: m["user"]}
        rest = {"event_id": m["event_id"], "ts": m["ts"], "source": m["source"]}
        lines.append(json.dumps({**rest, "features": body} if i % 3 else {**rest, **body}))
    _equal(_errors(_run(spark, lines, 3, _ewma(names))), _batch(spark))


def test_full_ensemble_on_the_stream_equals_frozen_scoring(spark):
    panel = panels.events(spark, SF).select(F.col("event_type").alias("series_key"), "ts", "event_id", F.col("value").cast("double").alias("value"),
                                            F.col("user_id").cast("double").alias("user"))
    fx = flows.fit_score(panel.drop("event_id"), ["series_key"], FEATS, W=16)
    batch = flows.score(panel, fx.params, tiebreak=["event_id"])
    newest = panel.groupBy("series_key").agg(F.max("ts").alias("newest"))
    want = {(r.series_key, r.ts): (r.score, r.flag) for r in batch.join(newest, "series_key").where("ts <= newest - interval 1 hour").collect()}
    lines = [json.dumps(m) for m in _disordered(_messages(spark), 1800)]
    out = _run(spark, lines, 4, lambda raw: S.score_events(S.parse_stream(raw, FEATS)[0], fx.params, watermark=DELAY))
    got = {(r.source, r.ts): (r.score, r.flag) for r in out.where("status = 'ok'").collect()}
    assert got.keys() == want.keys() and len(want) > 900
    assert all(math.isclose(got[k][0], want[k][0], rel_tol=1e-9, abs_tol=1e-9) and got[k][1] == want[k][1] for k in want)


def test_failure_of_one_source_is_its_own(spark):
    def model(wins):
        if (wins[:, :, 0] > 1e6).any():
            raise ValueError("out of range")
        return wins.mean(axis=(1, 2))

    messages = _messages(spark)
    broken = [dict(m, value=1e7) if m["source"] == "click" else m for m in messages]
    out = _run(spark, [json.dumps(m) for m in broken], 2, _ewma(extra={"mine": model}))
    assert {r.source for r in out.where("status = 'error'").select("source").distinct().collect()} == {"click"}
    assert out.where("status = 'error'").first().message == "ValueError: out of range"
    rest = {k: v for k, v in _batch(spark).items() if k[0] != "click"}
    _equal({k: v for k, v in _errors(out).items() if k[0] != "click"}, rest)
    assert out.where("status = 'ok' and err__mine is null").count() == 0


def test_sink_messages_and_options(spark, tmp_path):
    windows = _ewma()
    lines = [json.dumps(m) for m in _messages(spark)]
    raw = S.read_event_stream(spark, _write(lines, 2), max_files_per_trigger=1)
    query = S.start(S.as_messages(windows(raw)), str(tmp_path / "out"), str(tmp_path / "ckpt"), trigger=None, fmt="json",
                    options={"compression": "gzip"})
    query.processAllAvailable()
    query.stop()
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert len(rows) == len(_batch(spark)) and any(f.endswith(".gz") for f in os.listdir(tmp_path / "out"))
    body = json.loads(rows[0].value)
    assert body["source"] == rows[0].key and {"ts", "rn", "err__ewma", "status"} <= set(body)


def test_live_statistics_of_each_batch(spark, tmp_path):
    """Frozen parameters as static tables, per-batch live statistics appended."""
    sources = ("click", "view", "error", "purchase", "signup")
    norm = spark.createDataFrame([(s, "ewma", 1.0, 2.0) for s in sources], "source string, model string, mean double, std double")
    thr = spark.createDataFrame([(s, 0.5) for s in sources], "source string, threshold double")
    lines = [json.dumps(m) for m in _messages(spark)]
    raw = S.read_event_stream(spark, _write(lines, 3), max_files_per_trigger=1)
    scored = S.score_stream(_ewma()(raw), norm, thr, ["ewma"])
    out = str(tmp_path / "stats")
    query = (scored.writeStream.foreachBatch(S.live_stats_sink(out, FEATS))
             .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    query.processAllAvailable()
    h = S.health(query)
    query.stop()
    stats = spark.read.parquet(out)
    assert stats.agg(F.sum("n_windows")).first()[0] == len(_batch(spark))
    assert stats.select("batch_id").distinct().count() >= 2 and h["batch_id"] is not None
    row = stats.first()
    assert [f["feature"] for f in row.features] == FEATS and row.global_mean is not None


def test_metrics_folder_reload(spark):
    """New metric files are picked up incrementally; last write wins per label set (K2)."""
    folder = tempfile.mkdtemp(prefix="sg-metrics-")
    name = f"latest_{time.time_ns()}"
    q = (S.metrics_stream(spark, folder).writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="sg-ckpt-")).start())
    for i, v in enumerate([0.1, 0.4]):
        p = os.path.join(folder, f"live-{i}.json")
        with open(p, "w") as f:
            f.write(json.dumps({"metric": "anomaly_rate_live", "feature": "", "model_version": "m", "env": "prod",
                                "ts": f"2024-01-0{i + 1}T00:00:00", "value": v}) + "\n")
        t = time.time() - 100 + i
        os.utime(p, (t, t))
        q.processAllAvailable()
    q.stop()
    rows = spark.table(name).collect()
    assert len(rows) == 1 and rows[0].value == 0.4


def test_null_source_is_its_own_group(spark):
    folder = tempfile.mkdtemp(prefix="sg-nullsrc-")
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write('{"event_id": 1, "ts": "2024-01-01T00:00:00", "value": 1.0}\n'
                '{"event_id": 2, "ts": "2024-01-01T00:00:01", "source": null, "value": 2.0}\n'
                '{"event_id": 3, "ts": "2024-01-01T00:00:02", "source": "s", "value": 3.0}\n')
    good, _ = S.parse_stream(spark.read.text(folder), ["value"])
    assert sorted((r.source, r.event_id) for r in good.collect()) == [(S.NO_SOURCE, 1), (S.NO_SOURCE, 2), ("s", 3)]
    strict, rejected = S.parse_stream(spark.read.text(folder), ["value"], default_source=None)
    assert [r.event_id for r in strict.collect()] == [3] and [r.reason for r in rejected.collect()] == ["missing:source"] * 2


def test_a_silent_source_gives_its_tail(spark):
    """Rows that wait for a watermark come out by a timer, as in batch; nothing of it changes the windows before."""
    messages = _messages(spark)
    ev = panels.events(spark, SF).select(F.col("event_type").alias("series_key"), "ts", "event_id", F.col("value").cast("double").alias("value"),
                                         F.col("user_id").cast("double").alias("user"))
    want = {(r.series_key, r.ts): r.err for r in recon.detect(ev, ["series_key"], FEATS, 16, 1, ["ewma"]).collect()}
    assert len(want) > len(_batch(spark))
    early = [dict(messages[0], event_id=80_000 + i, ts="2999-01-01T00:00:00.000000") for i in range(2)]
    raw = S.read_event_stream(spark, _write([json.dumps(m) for m in [*early, *messages]], 3), max_files_per_trigger=1)
    name = f"out_{time.time_ns()}"
    query = S.start(_ewma(idle="6 seconds")(raw), None, tempfile.mkdtemp(prefix="sg-ckpt-"), trigger=None, fmt="memory", query_name=name)
    end = time.time() + 120
    while time.time() < end and query.exception() is None and spark.table(name).where("status = 'ok'").count() < len(want):
        time.sleep(1)
    query.stop()
    out = spark.table(name)
    _equal(_errors(out), want)
    assert sorted(r.event_id for r in out.where("status = 'ahead'").collect()) == [80_000, 80_001]


def test_learned_models_and_options_on_the_stream_equal_batch(spark, tmp_path):
    """Saved and loaded: PCA, a phase, weights and a pooled fit score the stream as they score a table."""
    panel = panels.events(spark, SF).select(F.col("event_type").alias("series_key"), "ts", "event_id", F.col("value").cast("double").alias("value"),
                                            F.col("user_id").cast("double").alias("user"))
    fx = flows.fit_score(panel.drop("event_id"), ["series_key"], FEATS, W=16, phase="hour(ts) % 6", weights=(0.7, 0.3), kernel=(0.2, 0.6, 0.2),
                         pooled=True, learn={"lin": {"kind": "pca", "k": 3}})
    fx.params.save(str(tmp_path / "p"))
    params = flows.Params.load(spark, str(tmp_path / "p"))
    assert params.info["learned"] == {"lin": fx.learned["lin"].version} == {"lin": params.learned["lin"].version}
    batch = flows.score(panel, params, tiebreak=["event_id"])
    assert {r.n_models for r in batch.select("n_models").distinct().collect()} == {4}
    newest = panel.groupBy("series_key").agg(F.max("ts").alias("newest"))
    want = {(r.series_key, r.ts): (r.score, r.flag) for r in batch.join(newest, "series_key").where("ts <= newest - interval 1 hour").collect()}
    lines = [json.dumps(m) for m in _messages(spark)]
    out = _run(spark, lines, 2, lambda raw: S.score_events(S.parse_stream(raw, FEATS)[0], params, watermark=DELAY))
    got = {(r.source, r.ts): (r.score, r.flag) for r in out.where("status = 'ok'").collect()}
    assert got.keys() == want.keys() and len(want) > 900
    assert all(math.isclose(got[k][0], want[k][0], rel_tol=1e-9, abs_tol=1e-9) and got[k][1] == want[k][1] for k in want)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.5, 1, [1.0, 2.0]), ("a", 1.5, 0, [2.0, 2.0]), ("b", 2.5, 1, [3.0, 2.0])],
                                 "source string, score double, flag int, x array<double>")
    out = str(tmp_path / "live")
    write = S.live_stats_sink(out, FEATS)
    write(rows, 0)
    write(rows.where("source = 'b'"), 1)
    before = sorted(map(str, spark.read.parquet(out).collect()))
    write(rows, 0)  # the batch failed after its write, and runs again
    assert sorted(map(str, spark.read.parquet(out).collect())) == before and len(before) == 3
    S.table_sink(str(tmp_path / "t"), lambda b: b.select("source"))(rows, 4)
    assert {(r.source, r.batch_id) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("a", 4), ("b", 4)}
