"""Calendar frequencies against the rules of pandas: inference, expected length, resampling."""

import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesguard.operators import calendar, grid

K = ["k"]
RULES = ["ME", "MS", "BME", "BMS", "2ME", "3MS", "QE-DEC", "QS-OCT", "QS-NOV", "BQE-NOV", "BQS-OCT", "2QE-OCT", "YE-DEC", "YS-JAN", "YS-APR",
         "BYE-JUN", "BYS-DEC", "2YE-MAR", "B", "W-MON", "2W-THU", "W-SUN", "WOM-2TUE", "WOM-4FRI", "D", "3D", "h", "6h", "15min", "s", "bh"]


def stamps(rule, start="2019-05-20", n=9, hour=0):
    return list(pd.date_range(start, periods=n, freq=rule) + pd.Timedelta(hours=hour))


def frame(spark, series):
    rows = [(k, t.to_pydatetime(), float(i)) for k, ts in series.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "k string, ts timestamp, v double").cache()


def cases():
    """Series that follow each rule, at several starts and times of day, and series that nearly do."""
    out = {}
    for rule, (start, hour), n in itertools.product(RULES, [("2019-05-20", 0), ("2020-02-29", 13), ("2023-12-31", 0)], [3, 4, 25]):
        ts = stamps(rule, start, n, hour)
        out[f"{rule} {start} {hour} {n}"] = ts
        if n == 25:
            out[f"{rule} {start} {hour} gap"] = ts[:4] + ts[6:17] + ts[18:]
    d = lambda *days: [pd.Timestamp(x) for x in days]
    out["weekend ends"] = d("2022-07-31", "2022-08-31", "2022-09-30", "2022-10-31")
    out["business ends, one at a weekend"] = d("2022-07-31", "2022-08-31", "2022-09-30", "2022-10-31", "2022-11-30", "2022-12-30", "2023-01-31")
    out["two"] = d("2022-01-31", "2022-02-28")
    out["months at noon and midnight"] = d("2022-01-31 12:00", "2022-02-28", "2022-03-31", "2022-04-30")
    out["same weekday, no week"] = d("2022-01-03", "2022-01-10", "2022-01-24", "2022-02-14")
    out["leap days"] = d("2016-02-29", "2020-02-29", "2024-02-29")
    return out


def test_inference_equals_pandas(spark):
    series = cases()
    got = {r.k: r.freq for r in grid.infer_freq(frame(spark, series), K).collect()}
    want = {k: pd.infer_freq(pd.DatetimeIndex(ts)) if len(ts) > 2 else None for k, ts in series.items()}
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_expected_ranges_equal_pandas(spark):
    series = {k: v for k, v in cases().items() if "bh" not in k}
    df = frame(spark, series)
    verdicts = {r.k: r for r in grid.irregularity(df, K).collect()}
    points = {}
    for r in grid.expected_grid(df, K, max_grid_ratio=1e9).collect():
        points.setdefault(r.k, []).append(pd.Timestamp(r.ts))
    for k, ts in series.items():
        freq = pd.infer_freq(pd.DatetimeIndex(ts)) if len(ts) > 2 else None
        step = pd.Series(ts).diff().dropna().value_counts().index[0]
        want = pd.date_range(min(ts), max(ts), freq=freq or step)
        assert verdicts[k].expected_len == len(want), k
        assert verdicts[k].is_irregular == (len(want) != len(ts)), k
        assert sorted(points.get(k, [])) == list(want), k


@pytest.mark.parametrize("rule", ["ME", "2QS-JAN", "BQE-DEC", "BMS", "B", "W-MON", "WOM-2TUE"])
def test_resampling_equals_pandas(spark, rule):
    """Rows at uneven times, on and off the dates, filled on the rule's dates."""
    r = pd.Series(range(40))
    starts = {"a": "2019-01-31", "b": "2019-02-05 07:00", "c": "2018-12-01", "d": "2020-02-29 12:00", "e": "2021-05-02"}
    series = {k: sorted({pd.Timestamp(s) + pd.Timedelta(hours=int(h)) for h in (r * r * 7 + 5 * r * len(k)) % 9000}) for k, s in starts.items()}
    series["month ends"] = [t for i, t in enumerate(stamps("ME", "2019-01-31", 20)) if i not in (3, 4, 9)]
    series["one row"] = [pd.Timestamp("2020-01-31 05:00")]
    df = frame(spark, series)
    got = {}
    for x in grid.resample_ffill(df, K, ["v"], rule=rule, only_irregular=False, keep_leading=True, max_grid_ratio=1e9).collect():
        got.setdefault(x.k, []).append((pd.Timestamp(x.ts), x.v))
    for k, ts in series.items():
        want = pd.Series([float(i) for i in range(len(ts))], index=pd.DatetimeIndex(ts)).resample(rule).ffill()
        assert sorted(got.get(k, []), key=lambda p: p[0]) == [(t, None if pd.isna(v) else v) for t, v in want.items()], k


def test_regular_calendar_series_stay_as_they_are(spark):
    series = {"ends": stamps("ME", n=24), "quarters": stamps("QS-OCT", n=12), "years": stamps("YS-JAN", n=6), "weeks": stamps("W-WED", n=30)}
    df = frame(spark, series)
    out = grid.resample_ffill(df, K, ["v"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.select("k", "ts", "v").collect()))


def test_blocks_give_the_same_points(spark):
    series = {"a": [t for i, t in enumerate(stamps("ME", "2001-01-31", 200)) if i % 7 != 3], "b": stamps("MS", "2010-01-01", 30)}
    df = frame(spark, series)
    whole = grid.resample_ffill(df, K, ["v"], rule="ME", only_irregular=False)
    blocks = grid.resample_ffill(df, K, ["v"], rule="ME", only_irregular=False, rows_per_block=16)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, blocks.collect()))


def test_rules_are_checked():
    assert calendar.parse_rule("2QS-OCT") == ("QS", 2, "OCT") and calendar.parse_rule("W") == ("W", 1, "SUN")
    for bad in ("", "XX", "ME-DEC", "W-DEC", "WOM", "WOM-5MON", "QS-MON", "bh"):
        with pytest.raises(ValueError, match="frequency"):
            calendar.parse_rule(bad)


def test_given_step_and_rule_exclude_each_other(spark):
    df = frame(spark, {"a": stamps("D")})
    with pytest.raises(ValueError, match="step or a rule"):
        grid.irregularity(df, K, freq_us=1, rule="ME")
    assert grid.irregularity(df, K).where(F.col("is_irregular")).count() == 0
