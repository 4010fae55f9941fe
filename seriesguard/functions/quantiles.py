"""Exact linear-interpolated quantiles per group without gathering a large group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer, which breaks when a series
holds a third of all rows. ``group_quantiles`` returns the same values (NumPy ``linear`` / DuckDB
``quantile_cont``). A quantile is a point between two neighbouring ranks, and every rank is looked up on
its own:

* ranks whose range holds at most ``small`` values: those values are sorted in one bounded buffer;
* other ranks: narrowing rounds. A round cuts the range at about ``bins`` approximate percentiles of its values
  (a mergeable sketch of bounded size), counts the values of each piece exactly (a partial aggregate with
  map-side combine) together with its exact min and max, and the rank goes on in the one piece that holds
  it. Pieces are monotone in the value, and the smallest and the largest value of a range always lie in pieces
  of their own, so every round shrinks the range, by about ``bins`` whatever the values' distribution, and rounds end
  when all ranges are small or constant. There is no cap on rounds.

All ranks of all quantiles take part in the same rounds over one written table of values. The state (one row
per group and rank) is written after each round, so lineage does not grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SMALL_GROUP = 50_000
BINS = 64


def group_quantile(df: DataFrame, keys: Sequence[str], col: str, qv: float, out: str = "quantile",
                   small: int = SMALL_GROUP, bins: int = BINS, max_group: int | None = None) -> DataFrame:
    """One row per group with at least one value: ``keys`` and the exact ``qv`` quantile.

    ``max_group`` (an upper bound of the largest group, e.g. the largest series) skips the size check."""
    if not 0.0 <= qv <= 1.0:
        raise ValueError(f"quantile must be in [0, 1], got {qv}")
    return group_quantiles(df, keys, col, {out: qv}, small=small, bins=bins, max_group=max_group)


def group_quantiles(df: DataFrame, keys: Sequence[str], col: str, qs: dict[str, float],
                    small: int = SMALL_GROUP, bins: int = BINS, max_group: int | None = None) -> DataFrame:
    """Several exact quantiles of ``col`` per group, one output column per entry of ``qs``.

    Null and NaN values take no part. When ``max_group <= small`` every group is known to be small, and
    Spark's exact ``percentile`` (same linear interpolation) is already bounded. All quantiles then
    come from one partial aggregate.
    """
    from seriesguard.session import materialize

    keys = list(keys)
    if not qs or any(not 0.0 <= v <= 1.0 for v in qs.values()):
        raise ValueError(f"quantiles must be in [0, 1], got {qs}")
    if bins < 2 or small < 1:
        raise ValueError("bins must be at least 2 and small at least 1")
    if not keys:  # one pooled group: group by a constant, then drop it
        return group_quantiles(df.withColumn("_g", F.lit(1)), ["_g"], col, qs, small, bins, max_group).drop("_g")
    x = F.col(col).cast("double")
    vals = df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if max_group is not None and max_group <= small:
        return vals.groupBy(*keys).agg(*[F.percentile("_x", float(v)).alias(name) for name, v in qs.items()])
    vals = materialize(vals, "quantile-values")
    state = materialize(_ranks(vals, keys, qs), "quantile-state")
    open_ranks = (F.col("_cnt") > small) & (F.col("_hi") > F.col("_lo"))
    while not state.where(open_ranks).isEmpty():
        state = materialize(_narrow(vals, state, keys, bins, open_ranks), "quantile-state")

    last = state.where((F.col("_hi") > F.col("_lo")))
    near = (vals.join(last, keys).where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
            .groupBy(*keys, "_q", "_side").agg(F.sort_array(F.collect_list("_x")).alias("_v")))
    at = state.join(near, [*keys, "_q", "_side"], "left")
    value = F.when(F.col("_hi") > F.col("_lo"), F.element_at("_v", (F.col("_r") - F.col("_below") + 1).cast("int")))
    at = at.select(*keys, "_q", "_side", "_frac", value.otherwise(F.col("_lo")).alias("_value"))

    def pick(name: str, side: int) -> Column:
        return F.max(F.when((F.col("_q") == name) & (F.col("_side") == side), F.col("_value")))

    def frac(name: str) -> Column:
        return F.max(F.when(F.col("_q") == name, F.col("_frac")))

    return at.groupBy(*keys).agg(*[(pick(n, 0) + (pick(n, 1) - pick(n, 0)) * frac(n)).alias(n) for n in qs])


def _ranks(vals: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """The two ranks (``_side`` 0 and 1) of every quantile in every group, with the whole group as range."""
    sizes = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))

    def rank(name: str, v: float, side: int) -> Column:
        h = (F.col("_cnt") - F.lit(1)).cast("double") * F.lit(float(v))
        return F.struct(F.lit(name).alias("_q"), F.lit(side).alias("_side"),
                        (F.ceil(h) if side else F.floor(h)).cast("long").alias("_r"), (h - F.floor(h)).alias("_frac"))

    ranks = F.array(*[rank(n, v, s) for n, v in qs.items() for s in (0, 1)])
    return (sizes.select(*keys, "_lo", "_hi", "_cnt", F.lit(0).cast("long").alias("_below"), F.explode(ranks).alias("_k"))
            .select(*keys, "_k._q", "_k._side", "_k._r", "_k._frac", "_lo", "_hi", "_below", "_cnt"))


def _narrow(vals: DataFrame, state: DataFrame, keys: list[str], bins: int, open_ranks: Column) -> DataFrame:
    """One round: every open rank's range becomes the piece that holds the rank."""
    big, done = state.where(open_ranks), state.where(~open_ranks)
    ranges = [*keys, "_lo", "_hi"]  # ranks with the same range share its counts
    inside = (vals.join(big.select(*ranges).distinct(), keys)
              .where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))))
    cuts = inside.groupBy(*ranges).agg(F.percentile_approx("_x", [i / bins for i in range(1, bins)], 16 * bins).alias("_cuts"))
    piece = (F.when(F.col("_x") <= F.col("_lo"), 0).when(F.col("_x") >= F.col("_hi"), bins + 1)
             .otherwise(F.size(F.filter("_cuts", lambda c: c <= F.col("_x"))) + 1))
    counted = (inside.join(cuts, ranges).groupBy(*ranges, piece.alias("_b"))
               .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_bmin"), F.max("_x").alias("_bmax")))
    before = Window.partitionBy(*ranges).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    first = F.col("_below") + F.col("_before")
    held = (big.drop("_cnt").join(counted, ranges)
            .where((F.col("_r") >= first) & (F.col("_r") < first + F.col("_c"))))
    return done.unionByName(held.select(*keys, "_q", "_side", "_r", "_frac", F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"),
                                        first.cast("long").alias("_below"), F.col("_c").cast("long").alias("_cnt")))
