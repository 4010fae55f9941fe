"""H4-H7: learned reconstruction detectors over flattened window vectors.

* H4 ``recon_pca``: a linear autoencoder. Centre on the training mean, fit principal components, back-project in Arrow
  batches. The components come from MLlib's covariance (a distributed tree aggregate) while that fits the driver, and from block
  power iteration beyond: tasks return products of their windows with a d x k basis, so nothing of size d x d exists.
* H5 ``recon_dense``: a dense autoencoder trained data-parallel. Training windows are written once into numbered buckets; each
  epoch takes a step for each bucket, in another order, and a step reads its bucket only. It broadcasts the weights, ``mapInPandas`` returns gradient sums per partition, an
  aggregate adds them up, and Adam runs on the driver over the small weight vector. Validation loss is
  computed the same way; the best epoch's weights are copied (defect X1 fixed). The per-epoch history goes
  to the run log (H7, A11).
* H6 ``score_windows``: any batch model ``(B, L*C) -> (B, L*C)`` through ``predict_batch_udf``.

A fitted model is a ``Model``: its arrays, with a version that is a hash of them. ``models_table`` and ``load_models`` write and
read any number of them as one table, and ``model_errors`` scores windows with a loaded one, in batch and on the stream.

Only weights and per-partition sums reach the driver. The window table is materialised once, so every
epoch re-reads it instead of recomputing its lineage. ``error_rows`` makes any of them a member of the ensemble.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_windows(win: DataFrame, col: str = "win", out: str = "x") -> DataFrame:
    """``(W, C)`` window arrays flattened to one ``L*C`` vector per window."""
    return win.withColumn(out, F.flatten(F.col(col))).drop(col)


#: Up to this many values a window the covariance, a d x d matrix on the driver (128 MB), is used; block power iteration beyond.
COVARIANCE_DIM = 4096


def error_rows(errors: DataFrame, keys: Sequence[str], model: str, ts: str = "ts") -> DataFrame:
    """Window errors of a learned or external model as rows of the error table, for ``flows.fit_score(more_errors=...)``."""
    return errors.select(*keys, "split", ts, "rn_split", F.lit(model).alias("model"), F.col("err").cast("double").alias("err"))


def fit_pca(flat: DataFrame, k: int, fit_split: str = "train", col: str = "x", method: str | None = None, **options) -> tuple[np.ndarray, np.ndarray]:
    """H4 fit: training mean and the top ``k`` principal directions (columns of a ``d x k`` matrix).

    ``method`` is ``covariance`` or ``power`` (``power_pca`` with its options); by default the first up to ``COVARIANCE_DIM`` values a window."""
    dim = flat.select(F.size(col)).first()[0]
    if method is None:
        method = "covariance" if dim <= COVARIANCE_DIM else "power"
    if method == "power":
        return power_pca(flat.where(F.col("split") == fit_split), dim, k, col, **options)
    if method != "covariance":
        raise ValueError(f"unknown method: {method}")
    rows = flat.where(F.col("split") == fit_split).select(array_to_vector(col).alias("_v"))
    scaler = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(rows)
    pca = PCA(k=k, inputCol="_c", outputCol="_p").fit(scaler.transform(rows))
    return np.asarray(scaler.mean.toArray()), np.asarray(pca.pc.toArray())


def _summed(rows: DataFrame, fn: Callable, width: int) -> np.ndarray:
    """The sum of the (d, width) arrays that ``fn`` makes of each partition's batches: rows are added up by Spark."""
    names = [f"s{j}" for j in range(width)]

    def run(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                part = fn(np.vstack(pdf.iloc[:, 0].to_numpy()))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame(total, columns=names).assign(i=np.arange(len(total)))

    parts = rows.mapInPandas(run, ", ".join(f"{n} double" for n in names) + ", i long")
    found = parts.groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).toPandas().sort_values("i")
    return found[names].to_numpy()


def power_pca(rows: DataFrame, dim: int, k: int, col: str = "x", extra: int = 8, max_iter: int = 100, tol: float = 1e-12,
              seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Mean and top ``k`` principal directions by block power iteration with ``k + extra`` directions.

    Each step broadcasts the basis Q and adds up Xc^T (Xc Q) over the partitions; the driver holds d x (k + extra) numbers and
    makes them orthonormal. It ends when the k directions turn by less than ``tol`` (one minus the cosine of the largest angle)."""
    spark = rows.sparkSession
    x = rows.select(col)
    n = x.count()
    mean = _summed(x, lambda m: m.sum(axis=0)[:, None], 1)[:, 0] / max(n, 1)
    width = min(dim, k + extra)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, width)))[0]
    for _ in range(max_iter):
        shipped = spark.sparkContext.broadcast((mean, basis))

        def product(m: np.ndarray, shipped=shipped) -> np.ndarray:
            centre, q = shipped.value
            c = m - centre
            return c.T @ (c @ q)

        moved = _summed(x, product, width)
        shipped.unpersist()
        values, turn = np.linalg.eigh(basis.T @ moved)  # Rayleigh-Ritz: the best directions inside the basis
        old = (basis @ turn)[:, ::-1][:, :k]
        basis = np.linalg.qr((moved @ turn)[:, ::-1])[0]
        if width == dim or np.linalg.svd(old.T @ basis[:, :k], compute_uv=False).min() > 1 - tol:
            break
    return mean, basis[:, :k]


def projection_errors(flat: DataFrame, mean: np.ndarray, pc: np.ndarray, col: str = "x",
                      out: str = "err") -> DataFrame:
    """Mean squared error between each vector and its back-projection ``mean + P P^T (x - mean)``."""
    mean_b = flat.sparkSession.sparkContext.broadcast(mean)
    pc_b = flat.sparkSession.sparkContext.broadcast(pc)

    @F.pandas_udf(T.DoubleType())
    def err(xs: pd.Series) -> pd.Series:
        X = np.vstack(xs.to_numpy()) - mean_b.value
        R = X @ pc_b.value @ pc_b.value.T
        return pd.Series(((X - R) ** 2).mean(axis=1))

    return flat.withColumn(out, err(F.col(col)))


def recon_pca(win: DataFrame, k: int = 4) -> DataFrame:
    flat = flat_windows(win)
    mean, pc = fit_pca(flat, k)
    return projection_errors(flat, mean, pc).drop("x")


def score_windows(flat: DataFrame, make_predict_fn: Callable, dim: int, batch_size: int = 1024,
                  col: str = "x", out: str = "err") -> DataFrame:
    """H6: reconstruct every window with a user model (loaded once per Python worker) and return the
    per-window mean squared error; rows keep their order inside each batch."""
    recon = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size,
                              input_tensor_shapes=[[dim]])
    r = flat.withColumn("_r", recon(F.col(col)))
    sq = F.aggregate(F.zip_with(F.col(col), F.col("_r"), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                     lambda acc, v: acc + v)
    return r.withColumn(out, sq / F.size(F.col(col))).drop("_r")


@dataclass(frozen=True)
class Model:
    """A fitted detector of windows: ``pca`` (mean, directions) or ``dense`` (the layers' weights and biases)."""

    kind: str
    arrays: tuple[np.ndarray, ...]

    @property
    def version(self) -> str:
        """The same for the same kind and values, wherever the model was fitted."""
        h = hashlib.sha256(self.kind.encode())
        for a in self.arrays:
            h.update(repr(a.shape).encode() + np.ascontiguousarray(a, "<f8").tobytes())
        return h.hexdigest()[:16]

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared reconstruction error of flat windows (n, W * C)."""
        if self.kind == "pca":
            mean, pc = self.arrays
            off = x - mean
            return ((off - off @ pc @ pc.T) ** 2).mean(axis=1)
        return ((_forward(x, self.arrays)[1] - x) ** 2).mean(axis=1)

    def window_errors(self, wins: np.ndarray) -> np.ndarray:
        """``errors`` of windows (n, W, C)."""
        return self.errors(wins.reshape(len(wins), -1))


def fit_model(flat: DataFrame, kind: str, **options) -> Model:
    """Fits on the flat windows of the ``train`` split (``fit_pca`` or ``recon_dense`` with their options)."""
    if kind == "pca":
        return Model(kind, fit_pca(flat, **options))
    if kind == "dense":
        return Model(kind, tuple(recon_dense(flat, **options)[0]))
    raise ValueError(f"unknown kind of model: {kind}")


MODEL_SCHEMA = "model string, version string, kind string, part int, shape array<int>, data binary"


def models_table(spark: SparkSession, models: Mapping[str, Model]) -> DataFrame:
    """One row for each array of each model; ``data`` holds little-endian doubles."""
    rows = [(name, m.version, m.kind, i, list(a.shape), np.ascontiguousarray(a, "<f8").tobytes())
            for name, m in sorted(models.items()) for i, a in enumerate(m.arrays)]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def load_models(table: DataFrame) -> dict[str, Model]:
    """The models of ``models_table``, as large as their weights; a table whose values don't fit its versions is an error."""
    parts: dict[str, list] = {}
    for r in table.select("model", "version", "kind", "part", "shape", "data").collect():
        parts.setdefault(r["model"], []).append(r)
    out = {}
    for name, rows in parts.items():
        rows.sort(key=lambda r: r["part"])
        arrays = tuple(np.frombuffer(bytes(r["data"]), "<f8").reshape(r["shape"]) for r in rows)
        out[name] = Model(rows[0]["kind"], arrays)
        if {r["version"] for r in rows} != {out[name].version}:
            raise ValueError(f"the stored model {name} is damaged or mixed from several versions")
    return out


def model_errors(flat: DataFrame, model: Model, col: str = "x", out: str = "err") -> DataFrame:
    """``flat`` with the model's error of each window; the model is shipped to each worker once."""
    shipped = flat.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def err(xs: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.errors(np.vstack(xs.to_numpy())))

    return flat.withColumn(out, err(F.col(col)))


def mean_predict_fn() -> Callable:
    """A closed-form model for H6: every value of a window is reconstructed by the window's mean."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            return np.repeat(x.mean(axis=1, keepdims=True), x.shape[1], axis=1)
        return predict
    return make


def pca_predict_fn(mean: np.ndarray, pc: np.ndarray) -> Callable:
    """A ``make_predict_fn`` for H6 built from an H4 fit (any other batch model plugs in the same way)."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return mean + c @ pc @ pc.T
        return predict
    return make


# ---------------------------------------------------------------- H5: dense autoencoder

def _init(d: int, h: int, seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [rng.normal(0, 1 / np.sqrt(d), (d, h)), np.zeros(h), rng.normal(0, 1 / np.sqrt(h), (h, d)), np.zeros(d)]


def _forward(X, p):
    W1, b1, W2, b2 = p
    Z = X @ W1 + b1
    H = np.tanh(Z)
    return H, H @ W2 + b2


def _grad_rows(params_b, with_grad: bool):
    """Sums over one partition as rows (i, s): the gradient by position, the loss at -1 and the windows at -2."""
    def run(batches):
        p = params_b.value
        d = p[0].shape[0]
        gs = [np.zeros_like(a) for a in p]
        loss, n = 0.0, 0
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.vstack(pdf["x"].to_numpy())
            H, Y = _forward(X, p)
            E = Y - X
            loss += float((E ** 2).sum()) / d
            n += len(X)
            if with_grad:
                dY = 2.0 * E / d
                gs[2] += H.T @ dY
                gs[3] += dY.sum(axis=0)
                dZ = (dY @ p[2].T) * (1 - H ** 2)
                gs[0] += X.T @ dZ
                gs[1] += dZ.sum(axis=0)
        flat = np.concatenate([g.ravel() for g in gs]) if with_grad else np.zeros(0)
        yield pd.DataFrame({"i": np.concatenate([[-1, -2], np.arange(len(flat))]), "s": np.concatenate([[loss, n], flat])})
    return run


def _pass(flat: DataFrame, params, with_grad: bool):
    """Mean loss and gradient over ``flat``: one job; only vectors of the model's size return."""
    pb = flat.sparkSession.sparkContext.broadcast(params)
    rows = (flat.select("x").mapInPandas(_grad_rows(pb, with_grad), "i long, s double")
            .groupBy("i").agg(F.sum("s").alias("s")).collect())
    pb.unpersist()
    found = {r["i"]: r["s"] for r in rows}
    n = max(found.get(-2, 0.0), 1.0)
    size = sum(a.size for a in params)
    grad = np.array([found.get(i, 0.0) for i in range(size)]) / n if with_grad else None
    return found.get(-1, 0.0) / n, n, grad


def recon_dense(flat: DataFrame, hidden: int = 8, epochs: int = 10, lr: float = 1e-2, clip: float = 1.0,
                seed: int = 42, run_id: str = "dense", steps: int = 4) -> tuple[list[np.ndarray], DataFrame]:
    """H5: returns the best weights and the per-epoch history ``(run_id, epoch, train_loss, val_loss)``.

    An epoch takes ``steps`` Adam steps, each over one bucket (by a hash of the row) of the training windows, so it reads every
    window once; the buckets' order changes from epoch to epoch."""
    from seriesguard.session import materialize

    bucket = F.pmod(F.xxhash64(*[c for c in flat.columns if c != "split"]), F.lit(steps)).cast("int").alias("bucket")
    train = materialize(flat.where(F.col("split") == "train").select("x", bucket), "buckets", ("bucket",))
    order = np.random.default_rng(seed + 1)
    val = flat.where(F.col("split") == "val").select("x")
    d = len(flat.select("x").first()["x"])
    params = _init(d, hidden, seed)
    shapes = [a.shape for a in params]
    m = [np.zeros_like(a) for a in params]
    v = [np.zeros_like(a) for a in params]
    b1, b2, eps = 0.9, 0.999, 1e-8
    best, best_val, history, t = None, np.inf, [], 0
    for epoch in range(1, epochs + 1):
        losses, seen = 0.0, 0.0
        for step in order.permutation(steps).tolist():
            loss, n, grad = _pass(train.where(F.col("bucket") == step), params, True)
            losses, seen, t = losses + loss * n, seen + n, t + 1
            norm = np.linalg.norm(grad)
            if norm > clip:
                grad = grad * (clip / norm)
            off = 0
            for i, shp in enumerate(shapes):
                size = int(np.prod(shp))
                g = grad[off:off + size].reshape(shp)
                off += size
                m[i] = b1 * m[i] + (1 - b1) * g
                v[i] = b2 * v[i] + (1 - b2) * g * g
                mh, vh = m[i] / (1 - b1 ** t), v[i] / (1 - b2 ** t)
                params[i] = params[i] - lr * mh / (np.sqrt(vh) + eps)
        val_loss = _pass(val, params, False)[0]
        history.append((run_id, epoch, losses / max(seen, 1.0), val_loss))
        if val_loss < best_val:
            best_val, best = val_loss, [a.copy() for a in params]
    hist = flat.sparkSession.createDataFrame(history, "run_id string, epoch int, train_loss double, val_loss double")
    return best, hist


def dense_errors(flat: DataFrame, params: list[np.ndarray], out: str = "err") -> DataFrame:
    pb = flat.sparkSession.sparkContext.broadcast(params)

    @F.pandas_udf(T.DoubleType())
    def err(xs: pd.Series) -> pd.Series:
        X = np.vstack(xs.to_numpy())
        _, Y = _forward(X, pb.value)
        return pd.Series(((Y - X) ** 2).mean(axis=1))

    return flat.withColumn(out, err(F.col("x")))


__all__ = ["flat_windows", "fit_pca", "projection_errors", "power_pca", "recon_pca", "score_windows", "pca_predict_fn",
           "mean_predict_fn", "error_rows", "recon_dense", "dense_errors", "Model", "fit_model", "models_table", "load_models",
           "model_errors"]
