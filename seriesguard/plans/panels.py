"""Panels: the series the operators consume, built from the supplied tables (FIXTURES.md §2).

All "dirt" is deterministic (functions of ``event_id``), so the DuckDB oracle repeats it exactly.
``ts`` is cast from ``timestamp_ntz`` to ``timestamp`` once here (session time zone is UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

P1_FEATURES = ["n_events", "sum_value", "avg_value", "max_value", "avg_k"]
P3_FEATURES = ["n_orders", "sum_total", "avg_total"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by ``event_type`` and hour. Partial aggregation before the shuffle."""
    ev = events(spark, sf_dir)
    return (ev.groupBy(F.col("event_type").alias("series_key"), F.date_trunc("hour", "ts").alias("ts"))
            .agg(F.count(F.lit(1)).cast("double").alias("n_events"),
                 F.sum("value").alias("sum_value"),
                 F.avg("value").alias("avg_value"),
                 F.max("value").alias("max_value"),
                 F.avg(F.get_json_object("props", "$.k").cast("double")).alias("avg_k")))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null times (``event_id % 97``), null values (``% 10``), repeated rows (``% 25``, ``tie = 1``)."""
    ev = events(spark, sf_dir)
    base = ev.select(
        F.col("event_type").alias("series_key"), "event_id",
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts")).alias("ts"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("v"),
        F.lit(0).alias("tie"))
    rep = (ev.where(F.col("event_id") % 25 == 0)
           .select(F.col("event_type").alias("series_key"), "event_id",
                   F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("timestamp"))
                   .otherwise(F.col("ts")).alias("ts"),
                   (F.col("value") + F.lit(1.0)).alias("v"), F.lit(1).alias("tie")))
    return base.unionByName(rep)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and day."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series_key"),
                      F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts"))
            .agg(F.count(F.lit(1)).cast("double").alias("n_orders"),
                 F.sum("o_totalprice").alias("sum_total"),
                 F.avg("o_totalprice").alias("avg_total")))


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row-level series per user."""
    ev = events(spark, sf_dir)
    return ev.select(F.col("user_id").cast("string").alias("series_key"), "event_id", "ts", "value")


def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time in several encodings, for profiling and detection; half of the epoch seconds are null."""
    ev = events(spark, sf_dir)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(iso).alias("ts_iso"),
        F.when(F.col("event_id") % 2 == 1, F.unix_seconds("ts")).alias("ts_epoch_s"),
        F.when(F.col("event_id") % 5 != 0, F.unix_millis("ts")).alias("ts_epoch_ms"),
        F.year("ts").alias("year"),
        F.when(F.col("event_id") % 2 == 0, F.lit("n/a")).otherwise(F.col("event_type")).alias("junk"),
        F.col("ts").cast("timestamp").alias("ts_native"),
        "value")


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: per-run metric by step (day index)."""
    ev = events(spark, sf_dir)
    return (ev.groupBy(F.col("event_type").alias("run_id"), (F.dayofyear("ts") - 1).alias("step"))
            .agg(F.round(F.avg("value"), 6).alias("value"))
            .withColumn("key", F.lit("avg_value"))
            .select("run_id", "key", F.col("step").cast("int").alias("step"), "value"))


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages; ``% 50`` broken, ``% 7`` with features nested under ``features``."""
    ev = table(spark, sf_dir, "events")
    ts_s = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    flat = F.to_json(F.struct(F.col("event_id"), ts_s.alias("ts"), F.col("event_type").alias("source"),
                              F.col("value"), F.col("user_id").cast("double").alias("user")))
    nested = F.to_json(F.struct(F.col("event_id"), ts_s.alias("ts"), F.col("event_type").alias("source"),
                                F.struct(F.col("value"), F.col("user_id").cast("double").alias("user"))
                                .alias("features")))
    value = (F.when(F.col("event_id") % 50 == 0, F.lit("{bad"))
             .when(F.col("event_id") % 7 == 0, nested).otherwise(flat))
    return ev.select("event_id", value.alias("value"))


def categorical_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric and three categorical columns of ``orders``, one with many categories."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.lit("orders").alias("series_key"), "o_orderkey",
                    F.col("o_orderdate").cast("timestamp").alias("ts"),
                    "o_totalprice", "o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string").alias("o_custkey"))


def calendar_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: orders on the dates of calendar rules, one series for each rule; ``*_gaps`` miss some dates."""
    o = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderdate AS TIMESTAMP) AS d", "o_totalprice")
    rules = {"month_end": "CAST(last_day(d) AS TIMESTAMP)", "month_noon": "date_trunc('month', d) + INTERVAL 12 HOURS",
             "two_months": "IF(month(d) % 2 = 1, date_trunc('month', d), NULL)", "quarter_start": "date_trunc('quarter', d)",
             "year_start": "date_trunc('year', d)", "year_end": "date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY",
             "week_monday": "date_trunc('week', d)", "business_day": "IF(weekday(d) < 5, date_trunc('day', d), NULL)",
             "month_end_gaps": "IF(month(d) NOT IN (2, 3, 7), CAST(last_day(d) AS TIMESTAMP), NULL)",
             "quarter_gaps": "IF(year(d) % 3 <> 1 OR quarter(d) <> 2, date_trunc('quarter', d), NULL)",
             "year_gaps": "IF(year(d) NOT IN (1994, 1996), date_trunc('year', d), NULL)",
             "week_gaps": "IF(weekofyear(d) % 5 <> 0, date_trunc('week', d) + INTERVAL 2 DAYS, NULL)"}
    stack = ", ".join(f"'{k}', {v}" for k, v in rules.items())
    rows = o.selectExpr(f"stack({len(rules)}, {stack}) AS (series_key, ts)", "o_totalprice").where("ts is not null")
    return rows.groupBy("series_key", "ts").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_total"))
