"""Column profile, ingestion gate and time-column detection.

A profile takes two passes over the table. One wide aggregate has every per-column quantity (C1-C4, C10) as
columns of one row, without exploding rows. One ordered pass (C5) range-partitions the parsed times by the input
order, compares each with the last one before it inside a range, and the ranges' ends with each other. Detection
(C6-C9) is then plain expressions over the small per-column profile table.

Shares follow the reference: a string column's parsed share is over all rows, an epoch column's over its
non-null rows, and in-range shares are over all rows.

Parsing rules (the oracle uses the same): strings parse with ``try_to_timestamp``; native timestamps are
taken as they are; a number is read as seconds or milliseconds since the epoch only when the result is
a representable nanosecond time (about years 1677-2262), as in pandas.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesguard.functions.columns import q
from seriesguard.plans import layout as L

# Fixed values of the reference detector and ingestion gate.
PARSE_THRESHOLD = 0.8
EPOCH_S_MEDIAN = 10_000_000
EPOCH_MS_MEDIAN = 1_000_000_000_000
EARLIEST = "1900-01-01 00:00:00"
RANGE_YEARS = 50
MAX_EPOCH_S = 9_223_372_036
MAX_EPOCH_MS = 9_223_372_036_854


def _kind(dt: T.DataType) -> str | None:
    if isinstance(dt, T.BooleanType):
        return None
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return None


def _epoch(x: Column, unit: str) -> Column:
    lim, fn = (MAX_EPOCH_S, F.timestamp_seconds) if unit == "s" else (MAX_EPOCH_MS, F.timestamp_millis)
    return F.when(F.abs(x) <= F.lit(lim), fn(F.floor(x).cast("long")))


def _parses(df: DataFrame, order: str, columns: Sequence[str] | None) -> list[tuple[str, str, Column, dict[str, Column]]]:
    """``(column, kind, value as double, parses)`` of every profiled column; ``parses`` maps t, t_s, t_ms to times."""
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    out = []
    for c in columns or df.columns:
        k = kinds.get(c)
        if not k or c == order:
            continue
        src = F.col(q(c))
        if k == "numeric":
            x = src.cast("double")
            x = F.when(~F.isnan(x), x)
            out.append((c, k, x, {"t_s": _epoch(x, "s"), "t_ms": _epoch(x, "ms")}))
        else:
            out.append((c, k, F.lit(None).cast("double"), {"t": F.try_to_timestamp(src) if k == "string" else src.cast("timestamp")}))
    return out


def _in_range(t: Column, now: Column) -> Column:
    return (t >= F.lit(EARLIEST).cast("timestamp")) & (t <= F.add_months(now, 12 * RANGE_YEARS))


def monotonic(df: DataFrame, order: str, parses: Sequence[tuple[str, str, Column, dict[str, Column]]],
              rows_per_range: int = L.ROWS_PER_SEGMENT) -> DataFrame:
    """Per column and parse, are the non-null parsed times non-decreasing in input order (``order`` unique)?

    A column with no parsed value counts as monotonic (as an empty pandas series does)."""
    from seriesguard.session import materialize

    names = [(c, v) for c, _, _, times in parses for v in times]
    cols = [t.alias(f"_v{i}") for i, t in enumerate(t for _, _, _, times in parses for t in times.values())]
    slim = df.select(F.col(q(order)).alias("_o"), *cols)
    n = max(1, -(-slim.count() // rows_per_range))
    if n > 1:
        slim = materialize(slim.repartitionByRange(n, "_o").withColumn("_part", F.spark_partition_id()), "ordered")
    else:
        slim = slim.withColumn("_part", F.lit(0))
    before = Window.partitionBy("_part").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    own = range(len(names))
    checked = slim.select("_part", "_o", *[F.col(f"_v{i}") for i in own],
                          *[F.coalesce(F.col(f"_v{i}") >= F.last(f"_v{i}", ignorenulls=True).over(before), F.lit(True)).alias(f"_ok{i}")
                            for i in own])
    known = lambda i: F.when(F.col(f"_v{i}").isNotNull(), F.col("_o"))
    ranges = checked.groupBy("_part").agg(*[x for i in own for x in (
        F.bool_and(f"_ok{i}").alias(f"_ok{i}"), F.min_by(f"_v{i}", known(i)).alias(f"_first{i}"), F.max_by(f"_v{i}", known(i)).alias(f"_last{i}"))])
    # one row for each range
    ends = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    joined = ranges.select(*[(F.col(f"_ok{i}") & F.coalesce(F.col(f"_first{i}") >= F.last(f"_last{i}", ignorenulls=True).over(ends), F.lit(True)))
                             .alias(f"_ok{i}") for i in own])
    row = joined.agg(*[F.bool_and(f"_ok{i}").alias(f"_ok{i}") for i in own])
    by_column = {}
    for i, (c, v) in enumerate(names):
        by_column.setdefault(c, {})[v] = F.coalesce(F.col(f"_ok{i}"), F.lit(True))
    entries = [F.struct(F.lit(c).alias("column"), *[oks.get(v, F.lit(True)).alias(f"mono{v[1:] or '_t'}") for v in ("t", "t_s", "t_ms")])
               for c, oks in by_column.items()]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def profile_columns(df: DataFrame, order: str, columns: Sequence[str] | None = None, now: str | None = None,
                    rows_per_range: int = L.ROWS_PER_SEGMENT) -> DataFrame:
    """One row per profiled column with every quantity C1-C10 need."""
    now_c = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    parses = _parses(df, order, columns)
    null_time = F.lit(None).cast("timestamp")
    aggs, entries = [F.count(F.lit(1)).alias("_n")], []
    for i, (c, kind, x, times) in enumerate(parses):
        numeric = kind == "numeric"
        raw_null = x.isNull() if numeric else F.col(q(c)).isNull()
        found = {"n_null": F.sum(raw_null.cast("long"))}
        for v, t in times.items():
            found[f"n_parsed{v[1:]}"] = F.count(t)
            found[f"n_in_range{v[1:]}"] = F.sum(_in_range(t, now_c).cast("long"))
        if numeric:
            found |= {"num_min": F.min(x), "num_max": F.max(x)}
            for name, limit in (("s", EPOCH_S_MEDIAN), ("ms", EPOCH_MS_MEDIAN)):
                # an exact test of the median against the limit: how many values reach it, and the values beside it
                found |= {f"reach_{name}": F.sum((x >= limit).cast("long")), f"under_{name}": F.max(F.when(x < limit, x)),
                          f"over_{name}": F.min(F.when(x >= limit, x))}
        else:
            found |= {"min_year": F.min(F.year(times["t"])), "max_year": F.max(F.year(times["t"]))}
        aggs += [agg.alias(f"_{name}_{i}") for name, agg in found.items()]
        get = lambda name, other, i=i, found=found: F.col(f"_{name}_{i}") if name in found else other
        zero, n_known = F.lit(0).cast("long"), F.col("_n") - F.coalesce(F.col(f"_n_null_{i}"), F.lit(0))
        reaches = {}
        for name, limit in (("s", EPOCH_S_MEDIAN), ("ms", EPOCH_MS_MEDIAN)):
            if numeric:
                half = (F.col(f"_under_{name}_{i}") + F.col(f"_over_{name}_{i}")) / 2 >= limit
                reach = 2 * F.col(f"_reach_{name}_{i}")
                reaches[name] = F.coalesce((reach > n_known) | ((reach == n_known) & half), F.lit(False))
            else:
                reaches[name] = F.lit(False)
        # the year span of a number read without a unit (nanoseconds) is 1970
        year = F.when(n_known > 0, F.lit(1970)) if numeric else None
        parsed = n_known if numeric else get("n_parsed", zero)
        entries.append(F.struct(
            F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col("_n").alias("n_rows"), get("n_null", zero).alias("n_null"),
            n_known.alias("n_known"), get("num_min", F.lit(None).cast("double")).alias("num_min"),
            get("num_max", F.lit(None).cast("double")).alias("num_max"), parsed.alias("n_parsed"),
            get("n_parsed_s", zero).alias("n_parsed_s"), get("n_parsed_ms", zero).alias("n_parsed_ms"),
            (parsed if numeric else F.coalesce(get("n_in_range", zero), zero)).alias("n_in_range"),
            F.coalesce(get("n_in_range_s", zero), zero).alias("n_in_range_s"), F.coalesce(get("n_in_range_ms", zero), zero).alias("n_in_range_ms"),
            (year if numeric else get("min_year", None)).cast("int").alias("min_year"),
            (year if numeric else get("max_year", None)).cast("int").alias("max_year"),
            reaches["s"].alias("median_is_s"), reaches["ms"].alias("median_is_ms")))
    agg = df.agg(*aggs).select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").where(F.col("n_rows") > 0)
    mono = monotonic(df, order, parses, rows_per_range)
    tot, known = F.col("n_rows").cast("double"), F.nullif(F.col("n_known").cast("double"), F.lit(0.0))
    share = lambda a, b: F.coalesce(F.col(a) / b, F.lit(0.0))
    return (agg.join(mono, "column")
            .withColumn("parse_ratio", share("n_parsed", tot)).withColumn("frac_in_range", share("n_in_range", tot))
            .withColumn("parse_ratio_s", share("n_parsed_s", known)).withColumn("frac_in_range_s", share("n_in_range_s", tot))
            .withColumn("parse_ratio_ms", share("n_parsed_ms", known)).withColumn("frac_in_range_ms", share("n_in_range_ms", tot)))


def plausible(prof: DataFrame) -> DataFrame:
    """C1 + C2: the ingestion gate per column (strict ``> 0.8``)."""
    lo, hi = F.col("num_min"), F.col("num_max")
    epoch_like = lo.between(1e9, 2e9) & hi.between(1e9, 2e9)
    year_like = lo.between(1900, 2100) & hi.between(1900, 2100)
    guard = F.when(F.col("kind") == "numeric", F.coalesce(epoch_like | year_like, F.lit(False))).otherwise(F.lit(True))
    years_ok = (F.col("min_year") > 1900) & (F.col("max_year") < 2100)
    is_time = guard & (F.col("parse_ratio") > PARSE_THRESHOLD) & F.coalesce(years_ok, F.lit(False))
    return prof.select("column", "kind", "parse_ratio", guard.alias("guard_ok"), is_time.alias("is_time_column"))


def gate_series(prof: DataFrame) -> DataFrame:
    """A table is a time series with at least one time column and one numeric column."""
    p = plausible(prof)
    return p.agg(F.sum(F.col("is_time_column").cast("int")).alias("n_time_columns"),
                 F.sum((F.col("kind") == "numeric").cast("int")).alias("n_numeric_columns")).select(
        "n_time_columns", "n_numeric_columns",
        ((F.col("n_time_columns") >= 1) & (F.col("n_numeric_columns") >= 1)).alias("is_series"))


def detect_scores(prof: DataFrame, threshold: float = PARSE_THRESHOLD) -> DataFrame:
    """C7-C9 scores per column: datetime (in-range + 0.2 monotonic), string (parsed + 0.2 in-range +
    0.1 monotonic), numbers by median unit (the better of seconds and milliseconds)."""
    mono = lambda c: F.when(F.col(c), F.lit(0.1)).otherwise(F.lit(0.0))
    s_score = F.col("parse_ratio_s") + F.lit(0.2) * F.col("frac_in_range_s") + mono("mono_s")
    ms_score = F.col("parse_ratio_ms") + F.lit(0.2) * F.col("frac_in_range_ms") + mono("mono_ms")
    as_s, as_ms = F.when(F.col("median_is_s"), s_score), F.when(F.col("median_is_ms"), ms_score)
    epoch = F.greatest(F.lit(0.0), as_s, as_ms)
    unit = F.when(F.col("median_is_ms") & (as_ms > F.coalesce(as_s, F.lit(0.0))), F.lit("ms")).when(F.col("median_is_s"), F.lit("s"))
    score = (F.when(F.col("kind") == "datetime",
                    F.col("frac_in_range") + F.when(F.col("mono_t"), F.lit(0.2)).otherwise(F.lit(0.0)))
             .when(F.col("kind") == "string",
                   F.col("parse_ratio") + F.lit(0.2) * F.col("frac_in_range") + mono("mono_t"))
             .otherwise(F.coalesce(epoch, F.lit(0.0))))
    return prof.select("column", "kind", score.alias("score"),
                       F.when(F.col("kind") == "numeric", unit).alias("unit"))


def detect_time_column(prof: DataFrame, column_order: Sequence[str], candidates: Sequence[str] = (),
                       threshold: float = PARSE_THRESHOLD) -> DataFrame:
    """Named candidates first, then the best datetime column (no threshold), then the best
    string column, then the best epoch number (both need ``score >= threshold``); ties go to the
    column that comes first. One row: ``column, stage, unit``, all null when no column is found."""
    pos = F.array_position(F.array(*[F.lit(c) for c in column_order]), F.col("column"))
    sc = detect_scores(prof, threshold).join(prof.select("column", "parse_ratio", "parse_ratio_s",
                                                          "parse_ratio_ms", "median_is_s", "median_is_ms"), "column")
    cand_pos = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("column")) if candidates \
        else F.lit(0)
    cand_ok = (F.when(F.col("kind") == "datetime", F.lit(True))
               .when(F.col("kind") == "string", F.col("parse_ratio") >= threshold)
               .otherwise((F.col("median_is_s") & (F.col("parse_ratio_s") >= threshold))
                          | (F.col("median_is_ms") & (F.col("parse_ratio_ms") >= threshold))))
    stage = (F.when((cand_pos > 0) & cand_ok, F.lit(0))
             .when(F.col("kind") == "datetime", F.lit(1))
             .when((F.col("kind") == "string") & (F.col("score") >= threshold), F.lit(2))
             .when((F.col("kind") == "numeric") & (F.col("score") >= threshold), F.lit(3)))
    ranked = sc.withColumn("_stage", stage).withColumn("_pos", pos).withColumn("_cpos", cand_pos)
    best = ranked.where(F.col("_stage").isNotNull()).agg(F.min_by(
        F.struct("column", "_stage", "unit"),
        F.struct("_stage", F.when(F.col("_stage") == 0, F.col("_cpos")).otherwise(F.lit(0)),
                 -F.col("score"), "_pos")).alias("_b"))
    stages = F.array(F.lit("candidate"), F.lit("datetime"), F.lit("string"), F.lit("epoch"))
    return best.select(F.col("_b.column").alias("column"),
                       F.when(F.col("_b").isNotNull(), F.get(stages, F.col("_b._stage"))).alias("stage"),
                       F.when(F.col("_b._stage") == 3, F.col("_b.unit")).alias("unit"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls (and NaN) per column in one aggregate pass, plus the total."""
    cols = list(columns or df.columns)
    types = dict(df.dtypes)
    nulls = [(F.col(q(c)).isNull() | (F.isnan(F.col(q(c))) if types[c] in ("double", "float") else F.lit(False)))
             for c in cols]
    row = df.agg(*[F.sum(x.cast("long")).alias(c) for c, x in zip(cols, nulls)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).alias("n_null")) for c in cols])
    return row.select(F.explode(entries).alias("_e")).select("_e.column", F.coalesce("_e.n_null", F.lit(0)).alias("n_null"))


def table_shape(df: DataFrame) -> DataFrame:
    """C11: number of rows and columns, and the column names in order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"),
                                                            F.lit(",".join(df.columns)).alias("columns"))


def ingest_metadata(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str]) -> DataFrame:
    """Per series first and last time, row count and feature list."""
    return df.groupBy(*keys).agg(F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
                                 F.count(F.lit(1)).alias("n_rows")).withColumn(
        "features", F.lit(",".join(features)))
