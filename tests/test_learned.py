"""H4-H7: PCA beats the mean, external scoring equals the PCA errors, dense losses fall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesguard.operators import learned, windows


@pytest.fixture(scope="module")
def flat(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
        F.sin(F.col("id") / 5.0).alias("a"), F.cos(F.col("id") / 5.0).alias("b"))
    from seriesguard.operators import split
    sp = split.chrono_split(df, ["k"])
    win = windows.sliding_windows(sp, ["k"], ["a", "b"], 8, 1)
    return learned.flat_windows(win.select("k", "split", "ts", "win")).cache()


def test_pca_beats_mean_and_external_equals(flat):
    mean, pc = learned.fit_pca(flat, 3)
    e_pca = {(r.k, r.ts): r.err for r in learned.projection_errors(flat, mean, pc).collect()}
    e0 = {(r.k, r.ts): r.err for r in learned.projection_errors(flat, mean, pc[:, :0]).collect()}
    assert np.mean(list(e_pca.values())) < 0.5 * np.mean(list(e0.values()))
    ext = learned.score_windows(flat, learned.pca_predict_fn(mean, pc), dim=16, batch_size=256)
    e_ext = {(r.k, r.ts): r.err for r in ext.collect()}
    assert e_ext.keys() == e_pca.keys()
    assert all(e_ext[k] == pytest.approx(e_pca[k], rel=1e-6, abs=1e-12) for k in e_pca)


def test_dense_losses_fall_and_best_is_kept(flat):
    best, hist = learned.recon_dense(flat, hidden=4, epochs=6, lr=0.05)
    rows = sorted(hist.collect(), key=lambda r: r.epoch)
    assert rows[-1].train_loss < rows[0].train_loss
    best_val = min(r.val_loss for r in rows)
    errs = learned.dense_errors(flat.where("split = 'val'"), best).agg(F.avg("err")).first()[0]
    assert errs == pytest.approx(best_val, rel=1e-6)


def test_models_are_saved_as_a_table(flat, tmp_path):
    """Loaded models give the errors of the fitted ones; a damaged table is noticed."""
    spark = flat.sparkSession
    models = {"lin": learned.fit_model(flat, "pca", k=3), "net": learned.fit_model(flat, "dense", hidden=3, epochs=1)}
    learned.models_table(spark, models).write.parquet(str(tmp_path / "m"))
    table = spark.read.parquet(str(tmp_path / "m"))
    again = learned.load_models(table)
    assert {n: m.version for n, m in again.items()} == {n: m.version for n, m in models.items()}
    x = np.vstack([r.x for r in flat.limit(50).collect()])
    for n in models:
        assert np.array_equal(again[n].errors(x), models[n].errors(x))
    mean, pc = models["lin"].arrays
    want = {(r.k, r.ts): r.err for r in learned.projection_errors(flat, mean, pc).collect()}
    assert {(r.k, r.ts): r.err for r in learned.model_errors(flat, again["lin"]).collect()} == pytest.approx(want)
    with pytest.raises(ValueError, match="damaged"):
        learned.load_models(table.withColumn("version", F.when(F.col("part") == 0, F.lit("x")).otherwise(F.col("version"))))
    with pytest.raises(ValueError, match="unknown kind"):
        learned.fit_model(flat, "forest")


def test_block_power_iteration_equals_the_covariance(spark, flat):
    """The same directions at 80 values a window; and a run at 16,000, where no covariance would fit."""
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 6)) @ r.normal(size=(6, 80)) * 2 + r.normal(size=(300, 80)) * 0.1 + 5
    df = spark.createDataFrame([("train", v.tolist()) for v in x] + [("val", [1e6] * 80)], "split string, x array<double>").repartition(3)
    mean, exact = learned.fit_pca(df, 4, method="covariance")
    again, power = learned.fit_pca(df, 4, method="power")
    assert np.allclose(mean, again) and np.linalg.svd(exact.T @ power, compute_uv=False).min() > 1 - 1e-9
    assert np.allclose(power.T @ power, np.eye(4))
    wide = r.normal(size=(40, 2)) @ r.normal(size=(2, 16_000)) + r.normal(size=(40, 16_000)) * 1e-3
    df = spark.createDataFrame([("train", v.tolist()) for v in wide], "split string, x array<double>")
    mean, pc = learned.fit_pca(df, 2, max_iter=10)
    off = wide - mean
    assert pc.shape == (16_000, 2) and ((off - off @ pc @ pc.T) ** 2).mean() < 1e-5


def test_an_epoch_reads_every_window_once(flat, monkeypatch):
    """Steps read disjoint buckets that together hold all training windows."""
    seen = []
    real = learned._pass
    monkeypatch.setattr(learned, "_pass", lambda df, p, g: (seen.append(real(df, p, g)) or seen[-1]))
    learned.recon_dense(flat, hidden=2, epochs=2, steps=3)
    n = flat.where("split = 'train'").count()
    steps = [s[1] for s in seen if s[2] is not None]
    assert len(steps) == 6 and sum(steps[:3]) == sum(steps[3:]) == n and min(steps) > n / 6
