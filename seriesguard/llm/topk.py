"""Exact top-k inner products with a vector-approximation file.

1. Components become integers. Each is also quantised to one of ``CELLS`` equal cells between the smallest
   and largest component of the table, a byte. Ids, integers and cells are written as one table; the scan
   reads the ids and cells only, an eighth of the integers' size.
2. Queries come in blocks of about ``QUERY_BLOCK``, shipped to the tasks. A task scans its cells: the inner
   product with a cell's lower corner, plus the cell's width times the positive (negative) components, bounds
   the score from above (below). It hands on the vectors whose upper bound reaches the k-th lower bound.
3. Over all tasks the k-th lower bound of a query is known; only vectors whose upper bound reaches it
   are read exactly, for then no other vector can be among the k best. Scores, ranks: joins and a window.

Of equal vectors only those with the k + 1 smallest ids can be in a result (one may be the query itself),
so the others aren't scanned; they are still queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import hash128

CELLS = 64
QUERY_BLOCK = 512
#: Vectors scanned at a time: with QUERY_BLOCK queries 16 MB of bounds.
SCAN_ROWS = 4096


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``id`` and ``v``, floor(scale * component) as array<long>, one row for each id.

    Rows with a null id, a null or empty vector, or null or non-finite components take no part. Of
    rows with the same id the smallest vector counts.
    """
    good = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & good)
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def approximation_file(vectors: DataFrame, k: int) -> tuple[DataFrame, int, int]:
    """The written table (``id``, ``v``, ``dims``, ``cells``, ``scanned``), the smallest component and the cells' width."""
    low, high = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (low, high) if low is not None else (0, 0)
    width = -(-(high - low + 1) // CELLS)
    among = F.row_number().over(Window.partitionBy(*hash128(F.col("v"))).orderBy("id"))
    marked = vectors.withColumn("among", among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat, at = v.flatten().to_numpy(), np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy())])
            cells = ((flat - low) // width).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), v, pa.array(np.diff(at).astype(np.int32)),
                 pa.array([cells[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                 pa.array(batch.column(2).to_numpy() <= k + 1)], names=["id", "v", "dims", "cells", "scanned"])

    written = marked.mapInArrow(run, "id long, v array<long>, dims int, cells binary, scanned boolean")
    return materialize(written, "va"), low, width


def _scan(cells: DataFrame, queries: list, low: int, width: int, k: int) -> DataFrame:
    """``query``, ``id`` and ``base`` (inner product with the cell's lower corner) of the vectors that this
    task can't rule out, for one block of queries (id, vector)."""
    by_dims: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims in {len(v) for _, v in queries}:
        own = [(i, v) for i, v in queries if len(v) == dims]
        by_dims[dims] = np.array([i for i, _ in own]), np.array([v for _, v in own], np.float64)
    shipped = cells.sparkSession.sparkContext.broadcast(by_dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: np.full((len(q[0]), k), -np.inf) for d, q in shipped.value.items()}  # the k highest bases
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d, (query, q) in shipped.value.items():
                slack = (width - 1) * np.abs(q).sum(1)  # between a vector's bounds
                rows = np.flatnonzero(dims == d)
                for a in range(0, len(rows), SCAN_ROWS):
                    part = batch.take(pa.array(rows[a:a + SCAN_ROWS]))
                    ids = part.column(0).to_numpy()
                    corner = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(ids), d)
                    base = q @ (corner.astype(np.float64) * width + low).T
                    base[query[:, None] == ids[None, :]] = -np.inf
                    top = np.concatenate([best[d], base], axis=1)
                    best[d] = np.partition(top, top.shape[1] - k, axis=1)[:, -k:]
                    kth = best[d].min(1)
                    of, at = np.nonzero((base >= (kth - slack)[:, None]) & (base > -np.inf))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query[of]), pa.array(ids[at]), pa.array(base[of, at].astype(np.int64)),
                         pa.array(slack[of].astype(np.int64))], names=["query", "id", "base", "slack"])

    return cells.select("id", "dims", "cells").mapInArrow(run, "query long, id long, base long, slack long")


def search(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: float = 256.0) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id`` and ``score`` (long): the k rows of ``table`` other than the
    query's own with the highest inner products, ties to the smaller id.

    Queries are the rows of ``table`` for which ``is_query`` (an expression over the column ``id``) holds.
    Vectors are compared with those of as many components. Fewer than k rows give fewer results.
    """
    spark = table.sparkSession
    rows, low, width = approximation_file(integer_vectors(table, id_col, vector_col, scale), k)
    asked = rows.where(is_query)
    blocks = -(-asked.count() // QUERY_BLOCK)
    path = scratch_path(spark, f"candidates-{uuid.uuid4().hex}")
    empty = "query long, id long, base long, slack long"
    spark.createDataFrame([], empty).write.mode("overwrite").parquet(path)
    for block in range(blocks):  # a block's queries are bounded; the cells are scanned once for each block
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).select("id", "v").collect()
        if own:
            _scan(rows.where("scanned"), [(r["id"], r["v"]) for r in own], low, width, k).write.mode("append").parquet(path)
    found = spark.read.schema(empty).parquet(path)

    # the k-th highest base over all tasks; an upper bound below the k-th lower bound rules a vector out
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("base").desc()))
    kth = found.withColumn("nth", nth).where(F.col("nth") <= k).groupBy("query").agg(
        F.count(F.lit(1)).alias("n"), F.min("base").alias("least"))
    left = found.join(kth.withColumnRenamed("query", "of"), F.col("query") == F.col("of"))
    left = left.where((F.col("n") < k) | (F.col("base") + F.col("slack") >= F.col("least"))).select("query", "id")

    exact = rows.select("id", F.col("v").alias("w"))
    scored = left.join(exact, "id").join(asked.select(F.col("id").alias("query"), "v"), "query")
    score = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x)
    scored = scored.select("query", "id", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    top = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
