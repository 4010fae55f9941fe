"""File sources, prefix scan, partitioned sinks and one-row records."""

import os
import tempfile

from pyspark.sql import functions as F

from seriesguard.operators import features
from seriesguard.sources import files
from tests.conftest import SF


def test_prefix_scan_one_series_per_file(spark):
    root = tempfile.mkdtemp(prefix="sg-prefix-")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "event_type", "value")
    for t in ("click", "view"):
        ev.where(F.col("event_type") == t).coalesce(1).write.option("header", True).csv(os.path.join(root, "in", t))
    with open(os.path.join(root, "in", "notes.txt"), "w") as f:
        f.write("not a series\n")
    df = files.read_prefix(spark, os.path.join(root, "in"), suffix=".csv")
    keys = df.select("series_key").distinct().count()
    assert keys == 2
    assert df.count() == ev.where(F.col("event_type").isin("click", "view")).count()


def test_csv_inferred_schema(spark):
    root = tempfile.mkdtemp(prefix="sg-csv-")
    out = os.path.join(root, "t")
    spark.createDataFrame([("2024-01-01T00:00:00", 1.5, 3)], "time string, x double, n int").write.option(
        "header", True).csv(out)
    df = files.read_series(spark, out)
    types = dict(df.dtypes)
    assert types["x"] == "double" and types["n"] == "int" and types["time"].startswith("timestamp")


def test_partitioned_sink_and_record_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="sg-sink-")
    df = spark.createDataFrame([("r1", "a", 1.0), ("r2", "b", 0.0)], "run_id string, k string, score double")
    files.write_table(df, os.path.join(root, "pred"), partition_by=["run_id"])
    back = spark.read.parquet(os.path.join(root, "pred"))
    assert sorted(r.run_id for r in back.collect()) == ["r1", "r2"]
    rec = {"window_size": 16, "step_size": 1, "feature_order": ["a", "b"], "timestamp_col": "ts"}
    files.save_record(spark, rec, os.path.join(root, "contract"))
    assert files.load_record(spark, os.path.join(root, "contract")) == rec
    c = features.contract(spark, 16, 1, ["a", "b"], "ts").collect()[0]
    assert c.encoded_width == 2 and len(c.schema_hash) == 16
