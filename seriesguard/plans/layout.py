"""Skew-safe layout for row-ordered work inside a series.

A series may hold a third of all rows, so ``Window.partitionBy(series_key)`` would put it on one task.
Instead:

1. ``row_index`` numbers rows inside each series. It range-partitions all rows by ``(series, time, tie-break)``, cuts each
   sorted partition into segments of ``rows_per_segment`` rows, runs ``row_number`` per ``(series, segment)`` and adds an
   offset from a small per-segment count table. Bounds come from sampled rows, so outliers, bursts and equal times (split
   by the tie-break) don't fill a partition. What the driver gets (samples, sizes and files of the partitions) follows their
   number, which small segments don't raise. The segmented rows are written once: counts and numbers see the same bounds,
   and a lost executor reads them again.
2. ``with_blocks`` cuts the numbered rows into blocks of ``rows_per_block`` rows and copies the last
   ``lookback`` rows of each block into the next one (``_halo``). Any window function that looks back at
   most ``lookback`` rows then runs with ``partitionBy(series, _blk)`` and gives the same answer as over the
   whole series; ``drop_halo`` removes the copies.
3. ``carry_forward`` / ``carry_backward`` finish unbounded frames (fills) across blocks with a per-block
   summary table whose size is ``rows / rows_per_block``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a segment unless a call says otherwise, and of a range partition where there are more than shuffle partitions.
ROWS_PER_SEGMENT = 1 << 20
ROWS_PER_BLOCK = 1 << 20
BLK = "_blk"
HALO = "_halo"


def seq_window(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "rn") -> Window:
    """Window spec for row-ordered work: by series (and block, when the frame is laid out)."""
    parts = list(keys) + ([BLK] if BLK in df.columns else [])
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*parts).orderBy(*order)


def row_index(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (),
              out: str = "rn", count_col: str | None = "n_rows",
              rows_per_segment: int = ROWS_PER_SEGMENT, max_rows: int | None = None) -> DataFrame:
    """0-based position of each row in its series ordered by ``(ts, *tiebreak)``.

    ``(ts, *tiebreak)`` must be a total order inside a series, otherwise numbers are not deterministic.
    Adds ``count_col`` (rows in the series) when given. ``max_rows`` (rows of the largest series, or an
    upper bound) picks the plan without another job; without it one small aggregate measures it.
    """
    keys = list(keys)
    order = [F.col(ts).asc_nulls_first()] + [F.col(t).asc_nulls_first() for t in tiebreak]
    if (max_rows if max_rows is not None else max_series_rows(df, keys)) <= rows_per_segment:
        # Every series fits one segment: a single window per series is bounded and needs one exchange.
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumn(out, F.row_number().over(w) - F.lit(1))
        if count_col:
            res = res.withColumn(count_col, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return res
    from seriesguard.session import materialize

    total = df.count()
    room = lambda rows: -(-total * 4 // (3 * rows))  # noqa: E731 - for uneven samples below the target
    shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(1, min(room(rows_per_segment), max(room(ROWS_PER_SEGMENT), shuffle_partitions)))
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = df.repartitionByRange(n_ranges, *by).sortWithinPartitions(*by)
    ranged = ranged.withColumn("_seg", F.monotonically_increasing_id())  # the partition's number << 33 | the place in it
    place = F.col("_seg").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = materialize(ranged.withColumn("_seg", F.col("_seg") - place % F.lit(rows_per_segment)), "segments")
    ranged = ranged.withColumn("_series", F.struct(*keys))  # structs join where a key is null, too
    counts = ranged.groupBy("_series", "_seg").agg(F.count(F.lit(1)).alias("_cnt"))
    series = Window.partitionBy("_series")
    before = series.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_series", "_seg", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(series).alias("_n"))
    w = Window.partitionBy("_series", "_seg").orderBy(*order)
    res = (ranged.join(offsets, ["_series", "_seg"])
           .withColumn(out, F.col("_off") + F.row_number().over(w) - F.lit(1)))
    if count_col:
        res = res.withColumn(count_col, F.col("_n"))
    return res.drop("_series", "_seg", "_off", "_n")


def max_series_rows(df: DataFrame, keys: Sequence[str], rn: str | None = None) -> int:
    """Rows of the largest series: one partial aggregate whose one-number result picks the plan
    (statistics-driven, like AQE). With ``rn`` present it is ``max(rn) + 1`` without a shuffle."""
    if rn and rn in df.columns:
        v = df.agg(F.max(rn)).first()[0]
        return 0 if v is None else int(v) + 1
    v = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(v or 0)


def with_blocks(df: DataFrame, keys: Sequence[str], lookback: int, rn: str = "rn",
                rows_per_block: int = ROWS_PER_BLOCK, max_rows: int | None = None) -> DataFrame:
    """Cut each series into blocks of ``rows_per_block`` rows plus a halo of ``lookback`` earlier rows.

    When ``max_rows`` shows that every series fits one block, the frame is returned as it is: window
    functions then partition by the series key alone and reuse the exchange of the row index, so a chain
    of sequential operators costs one shuffle.
    """
    if max_rows is not None and max_rows <= rows_per_block:
        return df
    if lookback >= rows_per_block:
        raise ValueError(f"lookback {lookback} must be smaller than rows_per_block {rows_per_block}")
    blk = F.floor(F.col(rn) / F.lit(rows_per_block)).cast("long")
    main = df.withColumn(BLK, blk).withColumn(HALO, F.lit(False))
    if lookback <= 0:
        return main
    pos = F.col(rn) % F.lit(rows_per_block)
    halo = (df.where(pos >= F.lit(rows_per_block - lookback))
            .withColumn(BLK, blk + F.lit(1)).withColumn(HALO, F.lit(True)))
    return main.unionByName(halo)


def drop_halo(df: DataFrame) -> DataFrame:
    if HALO in df.columns:
        df = df.where(~F.col(HALO)).drop(HALO)
    return df.drop(BLK) if BLK in df.columns else df


def _block_summary(df: DataFrame, keys: Sequence[str], cols: Sequence[str], rn: str, last: bool) -> DataFrame:
    """Last (or first) non-null value of each column in each block, with its row number."""
    pick = F.max_by if last else F.min_by
    aggs = [pick(F.col(c), F.when(F.col(c).isNotNull(), F.col(rn))).alias(c) for c in cols]
    base = df.where(~F.col(HALO)) if HALO in df.columns else df
    return base.groupBy(*keys, BLK).agg(*aggs)


def carry_forward(df: DataFrame, keys: Sequence[str], cols: Sequence[str], rn: str = "rn",
                  rows_per_block: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Forward fill (``last ignore nulls`` over all earlier rows) on a frame laid out by ``with_blocks``.

    Inside a block the frame is a window; what comes from earlier blocks is read from a per-block summary
    (one row per block) with a running ``last`` over blocks. Given the layout's ``rows_per_block``, the
    summary is skipped when every series fits one block.
    """
    keys = list(keys)
    inside = seq_window(df, keys, rn).rowsBetween(Window.unboundedPreceding, 0)
    out = df
    for c in cols:
        out = out.withColumn(c, F.last(F.col(c), ignorenulls=True).over(inside))
    if BLK not in df.columns or (rows_per_block and (
            max_rows if max_rows is not None else max_series_rows(df, keys, rn)) <= rows_per_block):
        return out
    summ = _block_summary(df, keys, cols, rn, last=True)
    prev = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, BLK, *[F.last(F.col(c), ignorenulls=True).over(prev).alias(f"_cf_{c}")
                                      for c in cols])
    out = out.join(carry, keys + [BLK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_cf_{c}"))).drop(f"_cf_{c}")
    return out


def carry_backward(df: DataFrame, keys: Sequence[str], cols: Sequence[str], rn: str = "rn",
                  rows_per_block: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Backward fill (first non-null of all later rows), the mirror of ``carry_forward``.

    Written as ``last ignore nulls`` over a *descending* order with an unbounded-preceding frame: Spark
    evaluates that frame incrementally, while a ``current row .. unbounded following`` frame is recomputed
    for every row (quadratic in the partition size).
    """
    keys = list(keys)
    parts = list(keys) + ([BLK] if BLK in df.columns else [])
    inside = Window.partitionBy(*parts).orderBy(F.col(rn).desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = df
    for c in cols:
        out = out.withColumn(c, F.last(F.col(c), ignorenulls=True).over(inside))
    if BLK not in df.columns or (rows_per_block and (
            max_rows if max_rows is not None else max_series_rows(df, keys, rn)) <= rows_per_block):
        return out
    summ = _block_summary(df, keys, cols, rn, last=False)
    nxt = Window.partitionBy(*keys).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, BLK, *[F.last(F.col(c), ignorenulls=True).over(nxt).alias(f"_cb_{c}")
                                      for c in cols])
    out = out.join(carry, keys + [BLK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_cb_{c}"))).drop(f"_cb_{c}")
    return out


def lag_in(df: DataFrame, keys: Sequence[str], col: str | Column, k: int, rn: str = "rn") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.lag(col, k).over(seq_window(df, keys, rn))
