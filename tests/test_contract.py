"""Driver contract: the entry runs, every oracle has a query, and a sample of queries equals the
DuckDB oracle at sf0.001 (the full set is checked at sf0.01 by scripts/check_oracle.py)."""

import math

import duckdb
import pytest

from tests.conftest import SF

SAMPLE = ["dedup_first", "ffill", "interpolate_time", "resample_ffill", "chrono_split", "windows_halo",
          "err_window", "flags", "feature_stats_ref", "alert_firing", "detect_time_column", "json_features",
          "latest_n"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=str)


def test_registry():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert set(df.columns) >= {"series_key", "ts", "score", "threshold", "flag"}
    assert df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, sdf.collect()) == _rows(dcols, res.fetchall())
