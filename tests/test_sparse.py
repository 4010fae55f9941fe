"""Series whose grid would be far larger than their rows."""

from datetime import datetime, timedelta

import pytest

from seriesguard.operators import grid
from seriesguard.plans import flows

T0 = datetime(2024, 1, 1)


@pytest.fixture
def panel(spark):
    bursts = [("bursts", T0 + timedelta(days=3 * k, seconds=j), float(10 * k + j)) for k in range(4) for j in range(5)]
    gap = [("gap", T0 + timedelta(hours=k), float(k)) for k in range(10) if k != 4]
    whole = [("whole", T0 + timedelta(hours=k), float(k)) for k in range(10)]
    return spark.createDataFrame(bursts + gap + whole, "series_key string, ts timestamp, v double")


def test_prepare_keeps_series_without_a_grid(panel):
    out = flows.prepare(panel, ["series_key"], ["v"])
    rows = lambda d: sorted(map(tuple, d.where("series_key = 'bursts'").select("series_key", "ts", "v").collect()))
    assert rows(out) == rows(panel) and len(rows(out)) == 20
    assert {x["series_key"]: x["count"] for x in out.groupBy("series_key").count().collect()} == {"bursts": 20, "gap": 10, "whole": 10}


@pytest.mark.parametrize("only_irregular", [True, False])
def test_resampling_keeps_or_leaves_out_large_grids(panel, only_irregular):
    verdicts = {x["series_key"]: x["valid"] for x in grid.grid_verdicts(panel, ["series_key"]).collect()}
    assert verdicts == {"bursts": False, "gap": True, "whole": True}
    for keep_large, n in ((False, 0), (True, 20)):
        out = grid.resample_ffill(panel, ["series_key"], ["v"], only_irregular=only_irregular, keep_large=keep_large)
        got = {x["series_key"]: x["count"] for x in out.groupBy("series_key").count().collect()}
        assert got.get("bursts", 0) == n and got["gap"] == 10 and got["whole"] == 10
