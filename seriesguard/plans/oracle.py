"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Each entry is a complete statement over the pre-registered views (``events``, ``orders``, ...). The
SQL is written from the operator semantics, not from our Spark code paths: plain window functions over
whole series, ``ASOF JOIN`` for resampling, ``quantile_cont`` for thresholds.
"""

from __future__ import annotations

# Constants of the queries, written out here so that a change of the engine's own shows.
DEFAULT_K = 3.0
DEFAULT_Q = 0.99
STD_EPS = 1e-12
ZERO_SCALE = 2.220446049250313e-15
EWMA_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
LOCAL_KERNEL = (0.25, 0.5, 0.25)
P1_FEATURES = ['n_events', 'sum_value', 'avg_value', 'max_value', 'avg_k']

ORACLE: dict[str, str] = {}
W = 16


def d(x: float) -> str:
    """A double literal that parses to exactly the Python float."""
    return f"CAST('{x!r}' AS DOUBLE)"


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def msq(diffs: list[str]) -> str:
    return "((" + " + ".join(f"({x}) * ({x})" for x in diffs) + f") / {d(float(len(diffs)))})"


# ---------------------------------------------------------------- panels

P1 = """p1 AS (
  SELECT event_type AS series_key, date_trunc('hour', ts) AS ts,
         CAST(count(*) AS DOUBLE) AS n_events, sum(value) AS sum_value, avg(value) AS avg_value,
         max(value) AS max_value, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS avg_k
  FROM events GROUP BY 1, 2)"""

P2 = """p2 AS (
  SELECT event_type AS series_key, event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS ts,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS v, 0 AS tie FROM events
  UNION ALL
  SELECT event_type, event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END, value + 1.0, 1
  FROM events WHERE event_id % 25 = 0)"""

P2_CLEAN = """p2c AS (
  SELECT series_key, ts, event_id, v, tie FROM (
    SELECT *, row_number() OVER (PARTITION BY series_key, ts ORDER BY tie) AS _r FROM p2 WHERE ts IS NOT NULL)
  WHERE _r = 1)"""

P3 = """p3 AS (
  SELECT o_orderpriority AS series_key, date_trunc('day', o_orderdate) AS ts,
         CAST(count(*) AS DOUBLE) AS n_orders, sum(o_totalprice) AS sum_total, avg(o_totalprice) AS avg_total
  FROM orders GROUP BY 1, 2)"""

P3B = """p3b AS (SELECT CAST(user_id AS VARCHAR) AS series_key, event_id, ts, value FROM events)"""

P10 = """cal AS (
  SELECT series_key, ts, count(*) AS n_orders, max(o_totalprice) AS max_total FROM (
    SELECT 'month_end' AS series_key, last_day(o_orderdate)::TIMESTAMP AS ts, o_totalprice FROM orders
    UNION ALL SELECT 'month_noon', date_trunc('month', o_orderdate) + INTERVAL 12 HOURS, o_totalprice FROM orders
    UNION ALL SELECT 'two_months', date_trunc('month', o_orderdate), o_totalprice FROM orders WHERE month(o_orderdate) % 2 = 1
    UNION ALL SELECT 'quarter_start', date_trunc('quarter', o_orderdate), o_totalprice FROM orders
    UNION ALL SELECT 'year_start', date_trunc('year', o_orderdate), o_totalprice FROM orders
    UNION ALL SELECT 'year_end', make_date(year(o_orderdate), 12, 31), o_totalprice FROM orders
    UNION ALL SELECT 'week_monday', date_trunc('week', o_orderdate), o_totalprice FROM orders
    UNION ALL SELECT 'business_day', date_trunc('day', o_orderdate), o_totalprice FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5
    UNION ALL SELECT 'month_end_gaps', last_day(o_orderdate), o_totalprice FROM orders WHERE month(o_orderdate) NOT IN (2, 3, 7)
    UNION ALL SELECT 'quarter_gaps', date_trunc('quarter', o_orderdate), o_totalprice FROM orders
      WHERE year(o_orderdate) % 3 <> 1 OR quarter(o_orderdate) <> 2
    UNION ALL SELECT 'year_gaps', date_trunc('year', o_orderdate), o_totalprice FROM orders WHERE year(o_orderdate) NOT IN (1994, 1996)
    UNION ALL SELECT 'week_gaps', date_trunc('week', o_orderdate) + INTERVAL 2 DAYS, o_totalprice FROM orders WHERE weekofyear(o_orderdate) % 5 <> 0)
  GROUP BY 1, 2)"""

P4 = """p4 AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts_iso,
         CASE WHEN event_id % 2 = 1 THEN epoch(ts) END AS ts_epoch_s, CASE WHEN event_id % 5 <> 0 THEN epoch_ms(ts) END AS ts_epoch_ms,
         year(ts) AS year,
         CASE WHEN event_id % 2 = 0 THEN 'n/a' ELSE event_type END AS junk, ts AS ts_native, value
  FROM events)"""


def given_step_ctes(src: str, name: str, step_us: int) -> list[str]:
    """Irregularity against a given grid step."""
    return [f"""{name}_irreg AS (SELECT *, CAST(floor((max_us - min_us) / freq_us) AS BIGINT) + 1 <> n_rows AS is_irregular FROM (
                 SELECT series_key, count(*) AS n_rows, min(epoch_us(ts)) AS min_us, max(epoch_us(ts)) AS max_us, {step_us} AS freq_us
                 FROM {src} GROUP BY 1))"""]


def freq_ctes(src: str, name: str) -> list[str]:
    """Deltas, modal delta (ties: first seen), inferred kind and grid step, irregularity."""
    return [
        f"""{name}_d AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_key ORDER BY ts))
                 AS delta_us FROM {src})""",
        f"""{name}_dc AS (SELECT series_key, delta_us, count(*) AS n, min(ts) AS first_seen
                  FROM {name}_d WHERE delta_us IS NOT NULL GROUP BY 1, 2)""",
        f"""{name}_modal AS (SELECT series_key, delta_us AS modal_us, n FROM (
                 SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY n DESC, first_seen) AS _r
                 FROM {name}_dc) WHERE _r = 1)""",
        f"""{name}_agg AS (SELECT series_key, count(*) AS n_rows, count(DISTINCT delta_us) AS n_steps,
                 min(delta_us) AS min_step, min(epoch_us(ts)) AS min_us, max(epoch_us(ts)) AS max_us,
                 bool_and(date_trunc('day', ts) = ts AND day(ts) = 1) AS all_month_start,
                 max(year(ts) * 12 + month(ts)) - min(year(ts) * 12 + month(ts)) + 1 AS month_span,
                 count(DISTINCT year(ts) * 12 + month(ts)) AS n_months,
                 bool_and(date_trunc('day', ts) = ts AND dayofweek(ts) BETWEEN 1 AND 5) AS all_weekday,
                 bool_and(delta_us IS NULL OR delta_us = 86400000000
                          OR (delta_us = 259200000000 AND dayofweek(ts - to_microseconds(delta_us)) = 5))
                   AS bday_steps
               FROM {name}_d GROUP BY 1)""",
        f"""{name}_kind AS (SELECT *, CASE WHEN n_rows < 3 THEN NULL WHEN n_steps = 1 THEN 'fixed'
                 WHEN all_month_start AND n_months = n_rows AND month_span = n_rows THEN 'month'
                 WHEN all_weekday AND bday_steps THEN 'business_day' END AS freq_kind FROM {name}_agg)""",
        f"""{name}_ir AS (SELECT k.series_key, k.n_rows, k.min_us, k.max_us, k.freq_kind,
                 COALESCE(CASE WHEN k.freq_kind = 'fixed' THEN k.min_step END, m.modal_us) AS freq_us
               FROM {name}_kind k LEFT JOIN {name}_modal m USING (series_key))""",
        f"""{name}_irr AS (SELECT *, CASE WHEN freq_us > 0 THEN CAST(floor((max_us - min_us) / freq_us) AS BIGINT) + 1
                 END AS expected_len FROM {name}_ir)""",
        f"""{name}_irreg AS (SELECT *, CASE WHEN freq_kind IN ('month', 'business_day') THEN false
                 ELSE COALESCE(expected_len <> n_rows, false) END AS is_irregular FROM {name}_irr)""",
    ]


def resample_ctes(src: str, name: str, cols: list[str], step_us: int | None = None) -> list[str]:
    """Grid anchored at midnight of the first day, as-of last row at or before each point;
    points before the first row dropped; regular series unchanged."""
    collist = ", ".join(f"s.{c}" for c in cols)
    return (given_step_ctes(src, name, step_us) if step_us else freq_ctes(src, name)) + [
        f"""{name}_g0 AS (SELECT series_key, min_us, freq_us,
                 epoch_us(date_trunc('day', make_timestamp(min_us))) AS anchor, max_us
               FROM {name}_irreg WHERE is_irregular AND freq_us IS NOT NULL)""",
        f"""{name}_g1 AS (SELECT series_key, min_us, freq_us,
                 anchor + CAST(floor((min_us - anchor) / freq_us) AS BIGINT) * freq_us AS lo,
                 anchor + CAST(floor((max_us - anchor) / freq_us) AS BIGINT) * freq_us AS hi FROM {name}_g0)""",
        f"""{name}_grid AS (SELECT series_key, make_timestamp(g) AS ts FROM (
                 SELECT series_key, min_us, unnest(generate_series(lo, hi, freq_us)) AS g FROM {name}_g1)
               WHERE g >= min_us)""",
        f"""{name} AS (
             SELECT g.series_key, g.ts, {collist} FROM {name}_grid g
               ASOF LEFT JOIN {src} s ON g.series_key = s.series_key AND g.ts >= s.ts
             UNION ALL
             SELECT s.series_key, s.ts, {collist} FROM {src} s JOIN {name}_irreg i USING (series_key)
             WHERE NOT i.is_irregular OR i.freq_us IS NULL)""",
    ]


def split_ctes(src: str, name: str = "sp") -> list[str]:
    return [
        f"""{name}_0 AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts) - 1 AS rn,
                 count(*) OVER (PARTITION BY series_key) AS n_rows FROM {src})""",
        f"""{name}_1 AS (SELECT *, n_rows - CAST(floor(CAST(n_rows AS DOUBLE) * {d(0.2)}) AS BIGINT) AS n_tv
               FROM {name}_0)""",
        f"""{name}_2 AS (SELECT *, n_tv - CAST(floor(CAST(n_tv AS DOUBLE) * {d(0.2)}) AS BIGINT) AS n_train
               FROM {name}_1)""",
        f"""{name} AS (SELECT * EXCLUDE (n_tv, n_train),
                 CASE WHEN rn < n_train THEN 'train' WHEN rn < n_tv THEN 'val' ELSE 'test' END AS split,
                 rn - CASE WHEN rn < n_train THEN 0 WHEN rn < n_tv THEN n_train ELSE n_tv END AS rn_split
               FROM {name}_2)""",
    ]


def scale_ctes(src: str, cols: list[str], name: str = "scaled") -> list[str]:
    aggs = ", ".join(f"avg({c}) AS mean__{c}, stddev_pop({c}) AS std__{c}" for c in cols)
    scl = ", ".join(f"""(s.{c} - f.mean__{c}) / CASE WHEN f.std__{c} IS NULL OR f.std__{c} < {d(ZERO_SCALE)}
                        THEN {d(1.0)} ELSE f.std__{c} END AS {c}""" for c in cols)
    return [
        f"{name}_fit AS (SELECT series_key, {aggs} FROM {src} WHERE split = 'train' GROUP BY 1)",
        f"""{name} AS (SELECT s.series_key, s.ts, s.rn, s.n_rows, s.split, s.rn_split, {scl}
               FROM {src} s LEFT JOIN {name}_fit f USING (series_key))""",
    ]


P1_PREP = [P1] + resample_ctes("p1", "prep", P1_FEATURES)
P1_SPLIT = P1_PREP + split_ctes("prep")
P1_SCALED = P1_SPLIT + scale_ctes("sp", P1_FEATURES)


def rows_ctes(src: str, cols: list[str], full_lags: bool = False) -> list[str]:
    """Row-level reconstructions (H1, H2) and the local-kernel terms (H3). H2 is a weighted mean over the previous rows
    of the split that exist; with full_lags rows lacking one of them have none."""
    wts = EWMA_WEIGHTS
    first = len(wts) if full_lags else 1
    wsum = " + ".join(f"CASE WHEN s.rn_split >= {k} THEN {d(wk)} ELSE 0.0 END" for k, wk in enumerate(wts, start=1))
    kl, kc, kr = (float(x) for x in LOCAL_KERNEL)
    ph = ", ".join(f"avg({c}) AS seasonal__{c}" for c in cols)
    ewma = ", ".join(
        f"CASE WHEN s.rn_split >= {first} THEN ("
        + " + ".join(f"CASE WHEN s.rn_split >= {k} THEN lag(s.{c}, {k}) OVER w * {d(wk)} ELSE 0.0 END" for k, wk in enumerate(wts, start=1))
        + f") / ({wsum}) END AS ewma__{c}" for c in cols)
    seas = msq([f"s.{c} - ph.seasonal__{c}" for c in cols])
    x1 = lambda c: f"lag(s.{c}, 1) OVER w"
    x2 = lambda c: f"lag(s.{c}, 2) OVER w"
    right = msq([f"s.{c} - ({d(kl)} * {x1(c)} + {d(kc)} * s.{c}) / {d(kl + kc)}" for c in cols])
    left = msq([f"{x1(c)} - ({d(kc)} * {x1(c)} + {d(kr)} * s.{c}) / {d(kc + kr)}" for c in cols])
    mid = msq([f"{x1(c)} - ({d(kl)} * {x2(c)} + {d(kc)} * {x1(c)} + {d(kr)} * s.{c}) / {d(kl + kc + kr)}"
               for c in cols])
    seas_sum = " + ".join(f"ph.seasonal__{c}" for c in cols)
    return [
        f"ph AS (SELECT series_key, hour(ts) AS _phase, {ph} FROM {src} WHERE split = 'train' GROUP BY 1, 2)",
        f"""rows0 AS (SELECT s.*, {seas} AS rowerr__seasonal, {seas_sum} AS seasonal_sum, {ewma},
                 {right} AS h3_right, {left} AS h3_left_prev, {mid} AS h3_mid_prev
               FROM {src} s LEFT JOIN ph ON s.series_key = ph.series_key AND hour(s.ts) = ph._phase
               WINDOW w AS (PARTITION BY s.series_key ORDER BY s.rn))""",
        "rows AS (SELECT *, " + msq([f"{c} - ewma__{c}" for c in cols]) + " AS rowerr__ewma, "
        + " + ".join(f"ewma__{c}" for c in cols) + " AS ewma_sum FROM rows0)",
    ]


def werr_ctes(step: int = 1) -> list[str]:
    return [
        f"""werr0 AS (SELECT series_key, split, ts, rn, rn_split,
               CASE WHEN count(rowerr__seasonal) OVER f = {W} THEN avg(rowerr__seasonal) OVER f END AS err__seasonal,
               CASE WHEN count(rowerr__ewma) OVER f = CASE WHEN rn_split = {W - 1} THEN {W - 1} ELSE {W} END
                 THEN avg(rowerr__ewma) OVER f END AS err__ewma,
               (lag(h3_left_prev, {W - 2}) OVER w + sum(h3_mid_prev) OVER f3 + h3_right) / {d(float(W))} AS err__local
             FROM rows
             WINDOW w AS (PARTITION BY series_key ORDER BY rn),
                    f AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW),
                    f3 AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN {W - 3} PRECEDING AND CURRENT ROW))""",
        f"""werr AS (SELECT * FROM werr0 WHERE rn_split >= {W - 1} AND (rn_split - {W - 1}) % {step} = 0)""",
        """errs AS (
             SELECT series_key, split, ts, rn_split, 'seasonal' AS model, err__seasonal AS err FROM werr
               WHERE err__seasonal IS NOT NULL
             UNION ALL SELECT series_key, split, ts, rn_split, 'ewma', err__ewma FROM werr WHERE err__ewma IS NOT NULL
             UNION ALL SELECT series_key, split, ts, rn_split, 'local', err__local FROM werr
               WHERE err__local IS NOT NULL)""",
    ]


DETECT = P1_SCALED + rows_ctes("scaled", P1_FEATURES) + werr_ctes()


def ensemble_ctes(normalization: str = "zscore", method: str = "quantile") -> list[str]:
    ctes = [f"""norms AS (SELECT series_key, model, avg(err) AS mean, stddev_pop(err) + {d(STD_EPS)} AS std
                 FROM errs WHERE split = 'val' GROUP BY 1, 2)"""]
    if normalization == "zscore":
        ctes.append("""zerr AS (SELECT e.series_key, e.split, e.ts, e.rn_split,
                 (e.err - n.mean) / CASE WHEN n.std > 0 THEN n.std ELSE 1.0 END AS err
               FROM errs e JOIN norms n USING (series_key, model))""")
    else:
        ctes.append("zerr AS (SELECT series_key, split, ts, rn_split, err FROM errs)")
    ctes.append("""scores AS (SELECT series_key, split, ts, rn_split, avg(err) AS score FROM zerr
                 GROUP BY 1, 2, 3, 4)""")
    if method == "quantile":
        ctes.append(f"""thr AS (SELECT series_key, quantile_cont(score, {d(DEFAULT_Q)}) AS threshold
                 FROM scores WHERE split = 'val' GROUP BY 1)""")
    else:
        ctes.append(f"""thr AS (SELECT series_key, avg(score) + {d(DEFAULT_K)} * stddev_pop(score) AS threshold
                 FROM scores WHERE split = 'val' GROUP BY 1)""")
    ctes.append("""flagged AS (SELECT s.*, t.threshold, CAST(s.score > t.threshold AS INTEGER) AS flag
                 FROM scores s JOIN thr t USING (series_key))""")
    return ctes


# ---------------------------------------------------------------- queries

ORACLE["coerce_ts"] = with_(P4) + """
SELECT event_id, CAST(try_cast(ts_iso AS TIMESTAMP) AS TIMESTAMP) AS ts_parsed FROM p4
WHERE try_cast(ts_iso AS TIMESTAMP) IS NOT NULL"""

ORACLE["sort_series"] = with_(P2) + """
SELECT series_key, event_id, tie, row_number() OVER (PARTITION BY series_key ORDER BY ts, tie) - 1 AS rn
FROM p2 WHERE ts IS NOT NULL"""

ORACLE["row_index"] = with_(P3B) + """
SELECT series_key, event_id, row_number() OVER (PARTITION BY series_key ORDER BY ts, event_id) - 1 AS rn,
       count(*) OVER (PARTITION BY series_key) AS n_rows FROM p3b"""

ORACLE["row_index_uneven"] = """
WITH e AS (
  SELECT CAST(event_id % 3 AS VARCHAR) AS series_key, event_id,
         CASE WHEN event_id < 3 THEN TIMESTAMP '1970-01-01 00:00:00' WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
              WHEN event_id % 8 = 1 THEN NULL ELSE make_timestamp(1706745600000000 + (epoch_us(ts) // 1000000) % 1000) END AS ts
  FROM events)
SELECT series_key, event_id, row_number() OVER (PARTITION BY series_key ORDER BY ts NULLS FIRST, event_id) - 1 AS rn,
       count(*) OVER (PARTITION BY series_key) AS n_rows FROM e"""

ORACLE["dedup_first"] = with_(P2, P2_CLEAN) + """
SELECT series_key, ts, event_id, round(v, 6) AS v, tie FROM p2c"""

ORACLE["ffill"] = with_(P2, P2_CLEAN) + """
SELECT series_key, ts, event_id,
       round(last_value(v IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS v FROM p2c"""

ORACLE["bfill"] = with_(P2, P2_CLEAN) + """
SELECT series_key, ts, event_id,
       round(first_value(v IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS v FROM p2c"""

ORACLE["interpolate_time"] = with_(P2, P2_CLEAN, """i0 AS (SELECT *,
       last_value(CASE WHEN v IS NOT NULL THEN v END IGNORE NULLS) OVER wp AS pv,
       last_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER wp AS pt,
       first_value(CASE WHEN v IS NOT NULL THEN v END IGNORE NULLS) OVER wn AS nv,
       first_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER wn AS nt
     FROM p2c
     WINDOW wp AS (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            wn AS (PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""") + """
SELECT series_key, ts, event_id, round(CASE
    WHEN v IS NOT NULL THEN v
    WHEN pv IS NOT NULL AND nv IS NOT NULL THEN
      CASE WHEN nt = pt THEN pv ELSE pv + (nv - pv) * (CAST(epoch_us(ts) - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END
    WHEN pv IS NOT NULL THEN pv ELSE nv END, 6) AS v
FROM i0"""

ORACLE["modal_delta"] = with_(P2, P2_CLEAN, *freq_ctes("p2c", "f")[:3]) + """
SELECT series_key, modal_us AS delta_us, n FROM f_modal"""

P1P3 = "p13 AS (SELECT series_key, ts FROM p1 UNION ALL SELECT series_key, ts FROM p3)"

ORACLE["infer_freq"] = with_(P1, P3, P1P3, *freq_ctes("p13", "f")) + """
SELECT series_key, freq_kind, CASE WHEN freq_kind = 'fixed' THEN min_step END AS freq_us FROM f_kind"""

ORACLE["is_irregular"] = with_(P1, P3, P1P3, *freq_ctes("p13", "f")) + """
SELECT series_key, n_rows, freq_us, expected_len, is_irregular FROM f_irreg"""

ORACLE["expected_grid"] = with_(P1, *freq_ctes("p1", "f")) + """
SELECT series_key, make_timestamp(g) AS ts FROM (
  SELECT series_key, unnest(generate_series(min_us, min_us + (expected_len - 1) * freq_us, freq_us)) AS g
  FROM f_irreg WHERE freq_us > 0)"""

ORACLE["grid_gaps"] = with_(P1, *freq_ctes("p1", "f")) + """
SELECT g.series_key, g.ts FROM (
  SELECT series_key, make_timestamp(unnest(generate_series(min_us, min_us + (expected_len - 1) * freq_us, freq_us))) AS ts
  FROM f_irreg WHERE freq_us > 0) g
ANTI JOIN p1 USING (series_key, ts)"""

ORACLE["resample_ffill"] = with_(*P1_PREP) + "SELECT series_key, ts, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in P1_FEATURES) + " FROM prep"

ORACLE["resample_given_step"] = with_(P1, *resample_ctes("p1", "prep", P1_FEATURES, 1_800_000_000)) + "SELECT series_key, ts, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in P1_FEATURES) + " FROM prep"

GRID_VERDICTS = with_(P3B, """own AS (SELECT series_key, ts FROM (SELECT *, row_number() OVER (PARTITION BY series_key, ts ORDER BY event_id) AS _r FROM p3b)
  WHERE _r = 1)""", *freq_ctes("own", "f"), """verdict AS (
  SELECT *, is_irregular AND coalesce(expected_len > n_rows * 100.0 + 16, false) AS large FROM f_irreg)""")

ORACLE["grid_verdicts"] = GRID_VERDICTS + """
SELECT series_key, n_rows, CASE WHEN large THEN format('grid of {} points for {} rows', expected_len, n_rows) END AS reason, NOT large AS valid
FROM verdict"""

ORACLE["grid_routed"] = GRID_VERDICTS + """
SELECT 'valid' AS route, CAST(coalesce(sum(n_rows) FILTER (NOT large), 0) AS BIGINT) AS n_rows FROM verdict
UNION ALL SELECT 'rejected', CAST(coalesce(sum(n_rows) FILTER (large), 0) AS BIGINT) FROM verdict"""

# Calendar rules: inferred from gaps between months and years and from positions in the month; grids by generate_series of intervals.
CAL_RULE = [
    """cd AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS step, date_diff('month', lag(ts) OVER w, ts) AS months,
         year(ts) - year(lag(ts) OVER w) AS years FROM cal WINDOW w AS (PARTITION BY series_key ORDER BY ts))""",
    """ca AS (SELECT series_key, count(*) AS n_rows, min(ts) AS lo, max(ts) AS hi, count(DISTINCT step) AS n_steps, min(step) AS step,
         max(step) AS longest, mode(step) AS usual, count(DISTINCT months) AS n_months, min(months) AS months, count(DISTINCT years) AS n_years,
         min(years) AS years, count(DISTINCT month(ts)) AS month_names, min(month(ts)) AS in_month, min(isodow(ts)) AS dow,
         bool_and(day(ts) = 1) AS starts, bool_and(ts::DATE = last_day(ts)) AS ends,
         bool_and(step IS NULL OR step = 86400000000 AND isodow(ts) > 1 OR step = 259200000000 AND isodow(ts) = 1) AS bdays
       FROM cd GROUP BY 1)""",
    """cr AS (SELECT *, CASE WHEN n_rows < 3 THEN NULL
         WHEN (starts OR ends) AND n_years = 1 AND month_names = 1 THEN IF(ends, 'YE', 'YS')
         WHEN (starts OR ends) AND n_months = 1 AND months % 3 = 0 THEN IF(ends, 'QE', 'QS')
         WHEN (starts OR ends) AND n_months = 1 THEN IF(ends, 'ME', 'MS')
         WHEN n_steps = 1 AND step % 604800000000 = 0 THEN 'W' WHEN n_steps = 1 THEN 'D'
         WHEN n_steps = 2 AND step = 86400000000 AND longest = 259200000000 AND bdays THEN 'B' END AS rule FROM ca)""",
    """cg AS (SELECT *, CASE rule WHEN 'YE' THEN list_transform(generate_series(lo, hi + INTERVAL 1 DAY, to_years(years::INTEGER)), lambda x: x)
           WHEN 'YS' THEN generate_series(lo, hi, to_years(years::INTEGER))
           WHEN 'QS' THEN generate_series(lo, hi, to_months(months::INTEGER)) WHEN 'MS' THEN generate_series(lo, hi, to_months(months::INTEGER))
           WHEN 'ME' THEN list_transform(generate_series(date_trunc('month', lo), hi, to_months(months::INTEGER)), lambda x: last_day(x)::TIMESTAMP)
           WHEN 'B' THEN list_filter(generate_series(lo, hi, INTERVAL 1 DAY), lambda x: isodow(x) < 6)
           ELSE generate_series(lo, hi, to_microseconds(IF(rule IN ('W', 'D'), step, usual))) END AS grid
       FROM cr WHERE series_key NOT LIKE '%gaps')""",
]

ORACLE["infer_calendar"] = with_(P10, *CAL_RULE[:3]) + """
SELECT series_key,
       CASE rule WHEN 'YE' THEN 'year_end' WHEN 'YS' THEN 'year' WHEN 'QE' THEN 'quarter_end' WHEN 'QS' THEN 'quarter' WHEN 'ME' THEN 'month_end'
         WHEN 'MS' THEN 'month' WHEN 'B' THEN 'business_day' ELSE IF(rule IS NULL, NULL, 'fixed') END AS freq_kind,
       CASE WHEN rule IN ('YE', 'YS') THEN IF(years > 1, years || '', '') || rule || '-' || upper(strftime(make_date(2000, in_month, 1), '%b'))
            WHEN rule IN ('QE', 'QS') THEN IF(months > 3, (months // 3) || '', '') || rule || '-' || ['DEC', 'OCT', 'NOV'][in_month % 3 + 1]
            WHEN rule IN ('ME', 'MS') THEN IF(months > 1, months || '', '') || rule
            WHEN rule = 'W' THEN IF(step > 604800000000, (step // 604800000000) || '', '') || 'W-'
              || ['MON', 'TUE', 'WED', 'THU', 'FRI', 'SAT', 'SUN'][dow]
            WHEN rule = 'D' THEN IF(step > 86400000000, (step // 86400000000) || '', '') || 'D' ELSE rule END AS freq
FROM cr"""

ORACLE["calendar_irregular"] = with_(P10, *CAL_RULE) + """
SELECT series_key, n_rows, len(grid) AS expected_len, len(grid) <> n_rows AS is_irregular FROM cg"""

ORACLE["calendar_grid"] = with_(P10, *CAL_RULE) + "SELECT series_key, unnest(grid) AS ts FROM cg"


def _resample_rule(series: str, points: str) -> str:
    """As of the points that ``points`` lists between ``lo`` and ``hi``, the first and last time of the series."""
    return with_(P10, f"""own AS (SELECT * FROM cal WHERE series_key = '{series}')""",
                 f"""pts AS (SELECT unnest({points}) AS ts FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM own))""") + """
SELECT o.series_key, p.ts, o.n_orders, round(o.max_total, 6) AS max_total FROM pts p ASOF JOIN own o ON p.ts >= o.ts"""


ORACLE["resample_month_end"] = _resample_rule(
    "month_end_gaps", "list_transform(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH), lambda x: last_day(x)::TIMESTAMP)")
ORACLE["resample_quarter_start"] = _resample_rule("quarter_gaps", "generate_series(lo, hi, INTERVAL 3 MONTHS)")
ORACLE["resample_year_start"] = _resample_rule("year_gaps", "generate_series(lo, hi, INTERVAL 1 YEAR)")
ORACLE["resample_weekly"] = _resample_rule("week_gaps", "generate_series(lo + INTERVAL 5 DAYS, hi + INTERVAL 5 DAYS, INTERVAL 7 DAYS)")

ORACLE["chrono_split"] = with_(*P1_SPLIT) + "SELECT series_key, ts, rn, split, rn_split FROM sp"

ORACLE["split_bounds"] = with_(*P1_SPLIT) + """
SELECT series_key, split, count(*) AS n_rows, min(ts) AS ts_min, max(ts) AS ts_max FROM sp GROUP BY 1, 2"""

ORACLE["scaler_fit"] = with_(*P1_SPLIT) + " UNION ALL ".join(
    f"""SELECT series_key, '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std,
        round(CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) < {d(ZERO_SCALE)} THEN 1.0
              ELSE stddev_pop({c}) END, 6) AS scale FROM sp WHERE split = 'train' GROUP BY 1"""
    for c in P1_FEATURES)

ORACLE["scaler_apply"] = with_(*P1_SCALED) + "SELECT series_key, ts, split, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in P1_FEATURES) + " FROM scaled"


def _windows_sql(step: int) -> str:
    first = P1_FEATURES[0]
    last = P1_FEATURES[-1]
    rowsum = " + ".join(P1_FEATURES)
    return with_(*P1_SCALED, f"""wq AS (SELECT series_key, split, ts, rn_split,
          sum({rowsum}) OVER f AS win_sum, lag({first}, {W - 1}) OVER w AS win_first, {last} AS win_last
        FROM scaled WINDOW w AS (PARTITION BY series_key ORDER BY rn),
                          f AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW))""") + f"""
SELECT series_key, split, ts, round(win_sum, 6) AS win_sum, round(win_first, 6) AS win_first,
       round(win_last, 6) AS win_last, {W * len(P1_FEATURES)} AS n_elems
FROM wq WHERE rn_split >= {W - 1} AND (rn_split - {W - 1}) % {step} = 0"""


ORACLE["windows_w16_s1"] = _windows_sql(1)
ORACLE["windows_w16_s4"] = _windows_sql(4)
ORACLE["windows_halo"] = _windows_sql(1)

ORACLE["short_series"] = with_(P3B) + """
SELECT series_key, count(*) AS n_rows,
       CAST(greatest(0, floor((count(*) - 64) / 1) + 1) AS BIGINT) AS n_windows,
       CASE WHEN count(*) < 64 THEN 'too_short' ELSE 'ok' END AS status
FROM p3b GROUP BY 1"""

ORACLE["window_shape"] = with_(*P1_SCALED) + f"""
SELECT series_key, split, count(*) AS n_windows, {W} AS L, {len(P1_FEATURES)} AS C
FROM scaled WHERE rn_split >= {W - 1} GROUP BY 1, 2"""

ORACLE["recon_seasonal"] = with_(*P1_SCALED, *rows_ctes("scaled", P1_FEATURES)) + """
SELECT series_key, ts, split, round(seasonal_sum, 6) AS recon_sum, round(rowerr__seasonal, 6) AS row_err FROM rows"""

ORACLE["recon_ewma"] = with_(*P1_SCALED, *rows_ctes("scaled", P1_FEATURES)) + """
SELECT series_key, ts, split, round(ewma_sum, 6) AS recon_sum, round(rowerr__ewma, 6) AS row_err FROM rows
WHERE rowerr__ewma IS NOT NULL"""

ORACLE["recon_local"] = with_(*DETECT) + """
SELECT series_key, split, ts, round(err, 6) AS err FROM errs WHERE model = 'local'"""

ORACLE["err_window"] = with_(*DETECT) + """
SELECT series_key, split, ts, model, round(err, 6) AS err FROM errs"""

ORACLE["err_timestep"] = with_(*P1_SCALED, *rows_ctes("scaled", P1_FEATURES), """terms AS (
    SELECT *, lead(h3_left_prev) OVER w AS h3_left, lead(h3_mid_prev) OVER w AS h3_mid FROM rows
    WINDOW w AS (PARTITION BY series_key ORDER BY rn))""", f"""pos AS (
    SELECT e.series_key, e.split, e.ts AS win_end_ts, CAST(r.rn - (e.rn - {W - 1}) AS INTEGER) AS pos, r.rowerr__seasonal,
           r.rowerr__ewma, r.h3_left, r.h3_mid, r.h3_right
    FROM rows e JOIN terms r ON r.series_key = e.series_key AND r.rn BETWEEN e.rn - {W - 1} AND e.rn
    WHERE e.rn_split >= {W - 1})""") + f"""
SELECT 'seasonal' AS model, series_key, split, win_end_ts, pos, round(rowerr__seasonal, 6) AS err FROM pos WHERE rowerr__seasonal IS NOT NULL
UNION ALL
SELECT 'ewma', series_key, split, win_end_ts, pos, round(rowerr__ewma, 6) FROM pos WHERE rowerr__ewma IS NOT NULL
UNION ALL
SELECT 'local', series_key, split, win_end_ts, pos,
       round(CASE pos WHEN 0 THEN h3_left WHEN {W - 1} THEN h3_right ELSE h3_mid END, 6) FROM pos"""

ORACLE["ensemble_none"] = with_(*DETECT, *ensemble_ctes("none")) + """
SELECT series_key, split, ts, round(score, 6) AS score FROM scores"""

ORACLE["normalizers_fit"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, model, round(mean, 6) AS mean, round(std, 6) AS std FROM norms"""

ORACLE["ensemble_zscore"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, split, ts, round(score, 6) AS score FROM scores"""

ORACLE["threshold_quantile"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, round(threshold, 6) AS threshold FROM thr"""

ORACLE["threshold_std"] = with_(*DETECT, *ensemble_ctes(method="std")) + """
SELECT series_key, round(threshold, 6) AS threshold FROM thr"""

ORACLE["threshold_pooled"] = """
WITH l AS (SELECT CAST(l_extendedprice AS DOUBLE) AS price, l_returnflag, l_linenumber FROM lineitem),
m AS (
  SELECT 'price' AS metric, price AS x FROM l
  UNION ALL SELECT 'returned', CAST(l_returnflag = 'R' AS DOUBLE) FROM l
  UNION ALL SELECT 'clusters', CASE WHEN l_linenumber % 2 = 0 THEN price + 1e9 ELSE price * 1e-9 END FROM l)
SELECT metric, round(quantile_cont(x, 0.5), 4) AS q50, round(quantile_cont(x, 0.75), 4) AS q75, round(quantile_cont(x, 0.99), 4) AS q99
FROM m GROUP BY metric"""

ORACLE["flags"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, split, ts, round(score, 6) AS score, round(threshold, 6) AS threshold, flag FROM flagged"""

ORACLE["score_frozen"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, ts, round(score, 6) AS score, round(threshold, 6) AS threshold, flag FROM flagged WHERE split = 'test'"""

ORACLE["results_table"] = with_(*DETECT, *ensemble_ctes()) + """
SELECT series_key, ts AS timestamp, round(score, 6) AS ensemble_error, flag FROM flagged WHERE split = 'test'"""


# ---------------------------------------------------------------- J: statistics

FITTED = DETECT + ensemble_ctes()


def _unpivot(src: str, cols: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT series_key{extra}, '{c}' AS feature, {c} AS x FROM {src}" for c in cols)


def stats_ctes(cols: list[str]) -> list[str]:
    """Reference statistics, error statistics and anomaly rates of a fitted chain over these features."""
    n, sx, sxx = d(float(len(cols))), " + ".join(cols), " + ".join(f"{c} * {c}" for c in cols)
    return [
        f"""wrows AS (SELECT s.*, CASE WHEN t._T >= {W} THEN CAST(greatest(0,
            floor(least(s.rn_split, t._T - {W}) / 1) - ceil(greatest(0, s.rn_split - {W - 1}) / 1) + 1) AS DOUBLE)
            ELSE 0.0 END AS _w
          FROM scaled s JOIN (SELECT series_key, max(rn_split) + 1 AS _T FROM scaled WHERE split = 'train' GROUP BY 1) t
          USING (series_key) WHERE s.split = 'train')""",
        "wlong AS (SELECT l.*, w._w FROM (" + _unpivot("wrows", cols, ", rn") + ") l JOIN wrows w USING (series_key, rn))",
        """fs_ref AS (SELECT series_key, feature, sum(_w * x) / sum(_w) AS mean,
            sqrt(greatest(sum(_w * x * x) / sum(_w) - (sum(_w * x) / sum(_w)) * (sum(_w * x) / sum(_w)), 1e-12)) AS std
          FROM wlong GROUP BY 1, 2 HAVING sum(_w) > 0)""",
        f"""gs_ref AS (SELECT series_key, sum(_w * ({sx})) / (sum(_w) * {n}) AS global_mean,
            sqrt(greatest(sum(_w * ({sxx})) / (sum(_w) * {n}) - (sum(_w * ({sx})) / (sum(_w) * {n}))
              * (sum(_w * ({sx})) / (sum(_w) * {n})), 1e-12)) AS global_std
          FROM wrows GROUP BY 1 HAVING sum(_w) > 0)""",
        """es_ref AS (SELECT series_key, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.95) AS p95
          FROM scores WHERE split = 'val' GROUP BY 1)""",
        "rate AS (SELECT series_key, split, avg(flag) AS anomaly_rate FROM flagged GROUP BY 1, 2)"]


STATS = FITTED + stats_ctes(P1_FEATURES)

ORACLE["error_stats"] = with_(*STATS) + "SELECT series_key, round(median, 6) AS median, round(p95, 6) AS p95 FROM es_ref"

ORACLE["error_by_model"] = with_(*FITTED) + """
SELECT series_key, model, split, round(avg(err), 6) AS err_mean, round(quantile_cont(err, 0.95), 6) AS err_p95
FROM errs GROUP BY 1, 2, 3"""

ORACLE["feature_stats_ref"] = with_(*STATS) + """
SELECT series_key, feature, round(mean, 6) AS mean, round(std, 6) AS std FROM fs_ref"""

ORACLE["global_stats_ref"] = with_(*STATS) + """
SELECT series_key, round(global_mean, 6) AS global_mean, round(global_std, 6) AS global_std FROM gs_ref"""

ORACLE["feature_stats_live"] = with_(*P1_SCALED, "lv AS (" + _unpivot(
    "(SELECT * FROM scaled WHERE split = 'test')", P1_FEATURES) + ")") + """
SELECT series_key, feature, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM lv GROUP BY 1, 2"""

ORACLE["global_stats_live"] = with_(*P1_SCALED, "lv AS (" + _unpivot(
    "(SELECT * FROM scaled WHERE split = 'test')", P1_FEATURES) + ")") + """
SELECT series_key, round(avg(x), 6) AS global_mean, round(stddev_pop(x), 6) AS global_std FROM lv GROUP BY 1"""

ORACLE["anomaly_rate"] = with_(*STATS) + "SELECT series_key, split, round(anomaly_rate, 6) AS anomaly_rate FROM rate"

_META_COLS = ", ".join(
    [f"round(max(CASE WHEN n.model = '{m}' THEN n.mean END), 6) AS norm_mean_{m}, "
     f"round(max(CASE WHEN n.model = '{m}' THEN n.std END), 6) AS norm_std_{m}" for m in ("seasonal", "ewma", "local")]
    + [f"round(max(CASE WHEN f.feature = '{c}' THEN f.mean END), 6) AS feature_mean_{c}, "
       f"round(max(CASE WHEN f.feature = '{c}' THEN f.std END), 6) AS feature_std_{c}" for c in P1_FEATURES])
ORACLE["meta_record"] = with_(*STATS) + f"""
SELECT t.series_key, 'zscore' AS normalization, round(t.threshold, 6) AS threshold, 'quantile' AS threshold_method,
       {d(DEFAULT_Q)} AS q, {d(DEFAULT_K)} AS k, round(e.median, 6) AS error_median, round(e.p95, 6) AS error_p95,
       round(r.anomaly_rate, 6) AS anomaly_rate_ref, round(g.global_mean, 6) AS global_mean,
       round(g.global_std, 6) AS global_std, {_META_COLS}
FROM thr t LEFT JOIN es_ref e USING (series_key) LEFT JOIN (SELECT * FROM rate WHERE split = 'val') r USING (series_key)
LEFT JOIN gs_ref g USING (series_key) LEFT JOIN norms n USING (series_key) LEFT JOIN fs_ref f USING (series_key)
GROUP BY t.series_key, t.threshold, e.median, e.p95, r.anomaly_rate, g.global_mean, g.global_std"""

ORACLE["feature_histogram"] = with_(*P1_SCALED, "hl AS (" + _unpivot("scaled", P1_FEATURES, ", split") + ")",
                                    """he AS (SELECT series_key, feature, min(x) AS lo, max(x) AS hi FROM hl
                                       WHERE split = 'train' GROUP BY 1, 2)""") + """
SELECT series_key, feature, split, CAST(CASE WHEN x < lo THEN 0 WHEN x > hi THEN 11 WHEN hi = lo THEN 1
         ELSE least(10, CAST(floor((x - lo) / (hi - lo) * 10.0) AS INTEGER) + 1) END AS INTEGER) AS bin,
       count(*) AS n
FROM hl JOIN he USING (series_key, feature) WHERE x IS NOT NULL GROUP BY 1, 2, 3, 4"""


# ---------------------------------------------------------------- K: drift and alerts

BLK = 6 * 3600 * 1_000_000
HALF_HOUR = 30 * 60 * 1_000_000
TICK = 30 * 1_000_000


def _blk(col: str) -> str:
    return f"make_timestamp(CAST((floor(epoch_us({col}) / {BLK}) + 1) * {BLK} AS BIGINT))"


def sample_ctes(cols: list[str]) -> list[str]:
    """Reference and live statistics as labelled samples."""
    return [
    "ref_ts AS (SELECT series_key, max(ts) AS rts FROM sp WHERE split = 'val' GROUP BY 1)",
    f"lrows AS (SELECT *, {_blk('ts')} AS bts FROM scaled WHERE split = 'test')",
    "llong AS (" + _unpivot("lrows", cols, ", bts") + ")",
    f"lwin AS (SELECT *, {_blk('ts')} AS bts FROM flagged WHERE split = 'test')",
    """samples AS (
      SELECT 'feature_mean_ref' AS metric, feature, series_key AS model_version, rts AS ts, mean AS value
        FROM fs_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'feature_std_ref', feature, series_key, rts, std FROM fs_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'feature_global_mean_ref', '', series_key, rts, global_mean FROM gs_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'feature_global_std_ref', '', series_key, rts, global_std FROM gs_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'error_median_ref', '', series_key, rts, median FROM es_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'error_p95_ref', '', series_key, rts, p95 FROM es_ref JOIN ref_ts USING (series_key)
      UNION ALL SELECT 'anomaly_rate_ref', '', series_key, rts, anomaly_rate FROM rate JOIN ref_ts USING (series_key)
        WHERE split = 'val'
      UNION ALL SELECT 'feature_mean_live', feature, series_key, bts, avg(x) FROM llong GROUP BY series_key, feature, bts
      UNION ALL SELECT 'feature_std_live', feature, series_key, bts, stddev_pop(x) FROM llong GROUP BY series_key, feature, bts
      UNION ALL SELECT 'feature_global_mean_live', '', series_key, bts, avg(x) FROM llong GROUP BY series_key, bts
      UNION ALL SELECT 'feature_global_std_live', '', series_key, bts, stddev_pop(x) FROM llong GROUP BY series_key, bts
      UNION ALL SELECT 'error_median_live', '', series_key, bts, quantile_cont(score, 0.5) FROM lwin GROUP BY series_key, bts
      UNION ALL SELECT 'error_p95_live', '', series_key, bts, quantile_cont(score, 0.95) FROM lwin GROUP BY series_key, bts
      UNION ALL SELECT 'anomaly_rate_live', '', series_key, bts, avg(flag) FROM lwin GROUP BY series_key, bts)""",
    "msamples AS (SELECT metric, feature, model_version, 'prod' AS env, ts, value FROM samples)",
    """latest AS (SELECT metric, feature, model_version, env, max(ts) AS ts, arg_max(value, ts) AS value
         FROM msamples GROUP BY 1, 2, 3, 4)""",
    "live AS (SELECT * FROM msamples WHERE metric LIKE '%\\_live' ESCAPE '\\')",
]


def rule_ctes(tick: int) -> list[str]:
    """As-of values at every tick, pairs, conditions, and states per tick."""
    return [
    """rng AS (SELECT model_version, min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM live GROUP BY 1)""",
    f"""ticks AS (SELECT l.metric, l.feature, l.model_version, l.env, make_timestamp(t.g) AS ts FROM
         (SELECT DISTINCT metric, feature, model_version, env FROM live) l JOIN
         (SELECT model_version, unnest(generate_series(CAST(ceil(lo / {tick}) * {tick} AS BIGINT), hi, {tick})) AS g
          FROM rng) t USING (model_version))""",
    f"""asofv AS (SELECT t.metric, t.feature, t.model_version, t.env, t.ts, s.value FROM ticks t
         ASOF JOIN live s ON t.metric = s.metric AND t.feature = s.feature AND t.model_version = s.model_version
           AND t.env = s.env AND t.ts >= s.ts)""",
    """pairs AS (SELECT regexp_replace(a.metric, '_live$', '') AS base, a.feature, a.model_version, a.env, a.ts,
           a.value AS live, r.value AS ref
         FROM asofv a JOIN latest r ON regexp_replace(r.metric, '_ref$', '') = regexp_replace(a.metric, '_live$', '')
           AND r.metric LIKE '%\\_ref' ESCAPE '\\'
           AND r.feature = a.feature AND r.model_version = a.model_version AND r.env = a.env)""",
    """rules(alert, base, kind, c, hold_s, severity, summary) AS (VALUES
         ('EnsembleErrorMedianHigh', 'error_median', 'ratio', 2.0, 300, 'warning',
          'Median reconstruction error doubled ({model_version})'),
         ('EnsembleErrorP95High', 'error_p95', 'ratio', 2.0, 300, 'critical',
          '95th percentile error > 2x baseline ({model_version})'),
         ('AnomalyRateSpike', 'anomaly_rate', 'scaled', 3.0, 600, 'critical',
          'Anomaly rate > 3x baseline ({model_version})'),
         ('FeatureMeanShift', 'feature_mean', 'shift', 0.5, 600, 'warning',
          'Feature[{feature}] mean drift > 0.5 ({model_version})'))""",
    """spread AS (SELECT model_version, env, max(CASE WHEN metric = 'error_p95_ref' THEN value END)
           - max(CASE WHEN metric = 'error_median_ref' THEN value END) AS sp FROM latest GROUP BY 1, 2)""",
    """conds AS (SELECT r.alert, p.feature, p.model_version, p.env, p.ts, p.live, p.ref, r.hold_s, r.severity, r.summary,
           COALESCE(CASE
             WHEN r.kind = 'ratio' THEN CASE WHEN p.ref > 0 THEN p.live / p.ref > CAST(r.c AS DOUBLE)
                                        ELSE p.live - p.ref > (CAST(r.c AS DOUBLE) - 1.0) * s.sp END
             WHEN r.kind = 'scaled' THEN p.live > CAST(r.c AS DOUBLE) * p.ref
             ELSE abs(p.live - p.ref) > CAST(r.c AS DOUBLE) END, false) AS active
         FROM pairs p JOIN rules r ON p.base = r.base LEFT JOIN spread s USING (model_version, env))""",
    """brk AS (SELECT *, CASE WHEN active AND NOT COALESCE(lag(active) OVER (PARTITION BY alert, feature,
           model_version, env ORDER BY ts), false) THEN 1 ELSE 0 END AS _brk FROM conds)""",
    """isl AS (SELECT *, sum(_brk) OVER (PARTITION BY alert, feature, model_version, env ORDER BY ts
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM brk)""",
    """states AS (SELECT *, CASE WHEN active THEN min(ts) OVER (PARTITION BY alert, feature, model_version, env, island, active)
           END AS active_since FROM isl)""",
    """states2 AS (SELECT *, CASE WHEN NOT active THEN 'inactive'
           WHEN epoch_us(ts) - epoch_us(active_since) >= CAST(hold_s AS BIGINT) * 1000000 THEN 'firing'
           ELSE 'pending' END AS state FROM states)""",
]


SAMPLES = STATS + sample_ctes(P1_FEATURES)
RULED = SAMPLES + rule_ctes(HALF_HOUR)
HELD = SAMPLES + rule_ctes(TICK)

_TWO = ["sum_value", "avg_value"]
_P_TWO = """p1 AS (
  SELECT event_type || '/' || CAST(user_id % 2 AS VARCHAR) AS series_key, date_trunc('hour', ts) AS ts, sum(value) AS sum_value,
         avg(value) AS avg_value FROM events GROUP BY 1, 2)"""
ORACLE["metric_samples_two_keys"] = with_(
    _P_TWO, *resample_ctes("p1", "prep", _TWO), *split_ctes("prep"), *scale_ctes("sp", _TWO), *rows_ctes("scaled", _TWO), *werr_ctes(),
    *ensemble_ctes(), *stats_ctes(_TWO), *sample_ctes(_TWO)) + """
SELECT metric, feature, model_version, env, ts, round(value, 6) AS value FROM msamples"""

ORACLE["metric_samples"] = with_(*SAMPLES) + """
SELECT metric, feature, model_version, env, ts, round(value, 6) AS value FROM msamples"""

ORACLE["metric_latest"] = with_(*SAMPLES) + """
SELECT metric, feature, model_version, env, ts, round(value, 6) AS value FROM latest"""

ORACLE["metric_asof"] = with_(*RULED) + """
SELECT metric, feature, model_version, env, ts, round(value, 6) AS value FROM asofv"""

ORACLE["drift_pairs"] = with_(*RULED) + """
SELECT base, feature, model_version, env, ts, round(live, 6) AS live, round(ref, 6) AS ref FROM pairs"""


def _rule_sql(kind: str) -> str:
    return with_(*RULED) + f"""
SELECT c.alert, c.feature, c.model_version, c.env, c.ts, round(c.live, 6) AS live, round(c.ref, 6) AS ref, c.active
FROM conds c JOIN rules r USING (alert) WHERE r.kind = '{kind}'"""


ORACLE["alert_ratio"] = _rule_sql("ratio")
ORACLE["alert_rate"] = _rule_sql("scaled")
ORACLE["alert_shift"] = _rule_sql("shift")

ORACLE["alert_firing"] = with_(*HELD) + """
SELECT alert, feature, model_version, env, state, min(ts) AS from_ts, max(ts) AS to_ts, count(*) AS n_ticks, active_since
FROM (SELECT *, row_number() OVER (PARTITION BY alert, feature, model_version, env ORDER BY ts)
             - row_number() OVER (PARTITION BY alert, feature, model_version, env, state, active_since ORDER BY ts) AS run FROM states2)
GROUP BY alert, feature, model_version, env, state, active_since, run"""

ORACLE["alert_messages"] = with_(*HELD) + """
SELECT alert, feature, model_version, env, severity, active_since, min(ts) AS fired_at,
       replace(replace(summary, '{model_version}', model_version), '{feature}', feature) AS message
FROM states2 WHERE state = 'firing' GROUP BY alert, feature, model_version, env, severity, active_since, summary"""


# ---------------------------------------------------------------- C: profile and detection

NOW = "2025-01-01 00:00:00"
P4_SPEC = [("ts_iso", "string"), ("ts_epoch_s", "numeric"), ("ts_epoch_ms", "numeric"), ("year", "numeric"),
           ("junk", "string"), ("ts_native", "datetime"), ("value", "numeric")]


def _col_rows(name: str, kind: str) -> str:
    if kind == "numeric":
        x = f"CASE WHEN isnan(CAST({name} AS DOUBLE)) THEN NULL ELSE CAST({name} AS DOUBLE) END"
        t = f"CASE WHEN ({x}) IS NOT NULL THEN TIMESTAMP '1970-01-01 00:00:00' END"
        raw_null = f"({x}) IS NULL"
    elif kind == "string":
        x, t, raw_null = "CAST(NULL AS DOUBLE)", f"try_cast({name} AS TIMESTAMP)", f"{name} IS NULL"
    else:
        x, t, raw_null = "CAST(NULL AS DOUBLE)", f"CAST({name} AS TIMESTAMP)", f"{name} IS NULL"
    ts_ = f"CASE WHEN abs({x}) <= 9223372036 THEN make_timestamp(CAST(floor({x}) AS BIGINT) * 1000000) END"
    tms = f"CASE WHEN abs({x}) <= 9223372036854 THEN make_timestamp(CAST(floor({x}) AS BIGINT) * 1000) END"
    return (f"SELECT '{name}' AS col, '{kind}' AS kind, event_id AS o, {raw_null} AS raw_null, {x} AS x, {t} AS t, "
            f"{ts_} AS t_s, {tms} AS t_ms FROM p4")


def _inr(c: str) -> str:
    return (f"CAST({c} >= TIMESTAMP '1900-01-01 00:00:00' AND {c} <= TIMESTAMP '{NOW}' + INTERVAL 50 YEAR AS BIGINT)")


def _mono(v: str) -> str:
    return f"""SELECT col, '{v}' AS variant, bool_and(ok) AS mono FROM (
      SELECT col, COALESCE({v} >= lag({v}) OVER (PARTITION BY col ORDER BY o, {v}), true) AS ok
      FROM plong WHERE {v} IS NOT NULL) GROUP BY 1"""


PROFILE = [P4, "plong AS (" + " UNION ALL ".join(_col_rows(n, k) for n, k in P4_SPEC) + ")",
           f"""pagg AS (SELECT col, kind, count(*) AS n_rows, sum(CAST(raw_null AS BIGINT)) AS n_null,
                 min(x) AS num_min, max(x) AS num_max, count(t) AS n_parsed, count(t_s) AS n_parsed_s,
                 count(t_ms) AS n_parsed_ms, sum({_inr('t')}) AS n_in_range, sum({_inr('t_s')}) AS n_in_range_s,
                 sum({_inr('t_ms')}) AS n_in_range_ms, min(year(t)) AS min_year, max(year(t)) AS max_year,
                 quantile_cont(x, 0.5) AS median
               FROM plong GROUP BY 1, 2)""",
           "pmono AS (" + " UNION ALL ".join(_mono(v) for v in ("t", "t_s", "t_ms")) + ")",
           """prof AS (SELECT a.*, CAST(n_parsed AS DOUBLE) / n_rows AS parse_ratio,
                 CAST(COALESCE(n_in_range, 0) AS DOUBLE) / n_rows AS frac_in_range,
                 COALESCE(CAST(n_parsed_s AS DOUBLE) / nullif(n_rows - n_null, 0), 0.0) AS parse_ratio_s,
                 CAST(COALESCE(n_in_range_s, 0) AS DOUBLE) / n_rows AS frac_in_range_s,
                 COALESCE(CAST(n_parsed_ms AS DOUBLE) / nullif(n_rows - n_null, 0), 0.0) AS parse_ratio_ms,
                 CAST(COALESCE(n_in_range_ms, 0) AS DOUBLE) / n_rows AS frac_in_range_ms,
                 COALESCE((SELECT mono FROM pmono m WHERE m.col = a.col AND m.variant = 't'), true) AS mono_t,
                 COALESCE((SELECT mono FROM pmono m WHERE m.col = a.col AND m.variant = 't_s'), true) AS mono_s,
                 COALESCE((SELECT mono FROM pmono m WHERE m.col = a.col AND m.variant = 't_ms'), true) AS mono_ms
               FROM pagg a)""",
           f"""pscore AS (SELECT *,
                 parse_ratio_s + {d(0.2)} * frac_in_range_s + CASE WHEN mono_s THEN {d(0.1)} ELSE 0.0 END AS s_score,
                 parse_ratio_ms + {d(0.2)} * frac_in_range_ms + CASE WHEN mono_ms THEN {d(0.1)} ELSE 0.0 END AS ms_score
               FROM prof)""",
           f"""pdet AS (SELECT col, kind, CASE
                   WHEN kind = 'datetime' THEN frac_in_range + CASE WHEN mono_t THEN {d(0.2)} ELSE 0.0 END
                   WHEN kind = 'string' THEN parse_ratio + {d(0.2)} * frac_in_range
                        + CASE WHEN mono_t THEN {d(0.1)} ELSE 0.0 END
                   ELSE COALESCE(greatest(0.0, CASE WHEN median >= 10000000 THEN s_score END,
                                          CASE WHEN median >= 1000000000000 THEN ms_score END), 0.0) END AS score,
                 CASE WHEN kind = 'numeric' THEN CASE
                   WHEN median >= 1000000000000 AND ms_score > COALESCE(CASE WHEN median >= 10000000 THEN s_score END, 0.0)
                     THEN 'ms' WHEN median >= 10000000 THEN 's' END END AS unit,
                 parse_ratio, parse_ratio_s, parse_ratio_ms, median
               FROM pscore)"""]


def _pick(columns: list[str], candidates: list[str]) -> str:
    pos = "CASE col " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(columns)) + " END"
    cpos = ("CASE col " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(candidates)) + " ELSE 0 END"
            if candidates else "0")
    return f"""
SELECT col AS column, CASE stg WHEN 0 THEN 'candidate' WHEN 1 THEN 'datetime' WHEN 2 THEN 'string' ELSE 'epoch' END
         AS stage, CASE WHEN stg = 3 THEN unit END AS unit
FROM (SELECT *, {cpos} AS cpos, {pos} AS pos, CASE
        WHEN {cpos} > 0 AND (CASE WHEN kind = 'datetime' THEN true WHEN kind = 'string' THEN parse_ratio >= 0.8
             ELSE (median >= 10000000 AND parse_ratio_s >= 0.8) OR (median >= 1000000000000 AND parse_ratio_ms >= 0.8)
             END) THEN 0
        WHEN kind = 'datetime' THEN 1
        WHEN kind = 'string' AND score >= 0.8 THEN 2
        WHEN kind = 'numeric' AND score >= 0.8 THEN 3 END AS stg
      FROM pdet WHERE col IN ({", ".join(f"'{c}'" for c in columns)}))
WHERE stg IS NOT NULL
ORDER BY stg, CASE WHEN stg = 0 THEN cpos ELSE 0 END, score DESC, pos LIMIT 1"""


ORACLE["profile_parse_ratio"] = with_(*PROFILE) + """
SELECT col AS column, kind, n_rows, n_parsed, round(parse_ratio, 6) AS parse_ratio FROM prof"""

ORACLE["profile_plausible"] = with_(*PROFILE) + """
SELECT col AS column, kind, round(parse_ratio, 6) AS parse_ratio, guard_ok,
       guard_ok AND parse_ratio > 0.8 AND COALESCE(min_year > 1900 AND max_year < 2100, false) AS is_time_column
FROM (SELECT *, CASE WHEN kind = 'numeric' THEN COALESCE(
        (num_min BETWEEN 1e9 AND 2e9 AND num_max BETWEEN 1e9 AND 2e9) OR
        (num_min BETWEEN 1900 AND 2100 AND num_max BETWEEN 1900 AND 2100), false) ELSE true END AS guard_ok FROM prof)"""

ORACLE["gate_series"] = with_(*PROFILE) + """
SELECT CAST(sum(CAST(t AS INTEGER)) AS BIGINT) AS n_time_columns,
       CAST(sum(CAST(kind = 'numeric' AS INTEGER)) AS BIGINT) AS n_numeric_columns,
       sum(CAST(t AS INTEGER)) >= 1 AND sum(CAST(kind = 'numeric' AS INTEGER)) >= 1 AS is_series
FROM (SELECT kind, (CASE WHEN kind = 'numeric' THEN COALESCE(
        (num_min BETWEEN 1e9 AND 2e9 AND num_max BETWEEN 1e9 AND 2e9) OR
        (num_min BETWEEN 1900 AND 2100 AND num_max BETWEEN 1900 AND 2100), false) ELSE true END)
        AND parse_ratio > 0.8 AND COALESCE(min_year > 1900 AND max_year < 2100, false) AS t FROM prof)"""

ORACLE["frac_in_range"] = with_(*PROFILE) + """
SELECT col AS column, round(frac_in_range, 6) AS frac_in_range, round(frac_in_range_s, 6) AS frac_in_range_s,
       round(frac_in_range_ms, 6) AS frac_in_range_ms FROM prof"""

ORACLE["is_monotonic"] = with_(*PROFILE) + "SELECT col AS column, mono_t, mono_s, mono_ms FROM prof"

_P4_ORDER = [n for n, _ in P4_SPEC]
ORACLE["detect_candidates"] = with_(*PROFILE) + _pick(_P4_ORDER, ["ts_epoch_ms", "ts_iso"])
ORACLE["detect_time_column"] = with_(*PROFILE) + _pick([c for c in _P4_ORDER if c != "ts_native"], [])

for _k, _kind in (("detect_datetime", "datetime"), ("detect_string", "string"), ("detect_epoch", "numeric")):
    ORACLE[_k] = with_(*PROFILE) + f"""
SELECT col AS column, kind, round(score, 6) AS score, unit FROM pdet WHERE kind = '{_kind}'"""

ORACLE["null_profile"] = with_(P2) + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM p2"
    for c in ("series_key", "event_id", "ts", "v", "tie"))

ORACLE["head5"] = "SELECT event_id, ts, event_type, round(value, 6) AS value FROM events ORDER BY event_id LIMIT 5"

ORACLE["table_shape"] = """
SELECT count(*) AS n_rows, 3 AS n_columns, 'o_orderkey,o_custkey,o_totalprice' AS columns FROM orders"""

ORACLE["ingest_metadata"] = with_(P1) + f"""
SELECT series_key, min(ts) AS ts_min, max(ts) AS ts_max, count(*) AS n_rows, '{",".join(P1_FEATURES)}' AS features
FROM p1 GROUP BY 1"""


# ---------------------------------------------------------------- A, B: sources, messages, routing

ORACLE["scan_csv_roundtrip"] = with_(P1) + "SELECT series_key, ts, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in P1_FEATURES) + " FROM p1"

ORACLE["events_to_json"] = """
SELECT event_id, CAST(json_object('event_id', event_id, 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
       'user_id', user_id, 'event_type', event_type, 'value', value) AS VARCHAR) AS value FROM events"""

ORACLE["project_features"] = with_(P1) + "SELECT series_key, ts, " + ", ".join(
    f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in P1_FEATURES) + " FROM p1"

ORACLE["ts_label"] = with_(P2) + """
SELECT series_key, event_id, tie, COALESCE(strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(event_id AS VARCHAR)) AS label
FROM p2"""

P7 = """p7 AS (SELECT event_id, event_type AS source, ts, value, CAST(user_id AS DOUBLE) AS usr,
          event_id % 50 = 0 AS bad, event_id % 7 = 0 AS nested FROM events)"""

ORACLE["json_flatten"] = with_(P7) + """
SELECT event_id, source, CASE WHEN nested THEN NULL ELSE round(value, 6) END AS value,
       CASE WHEN nested THEN NULL ELSE round(usr, 6) END AS "user",
       CASE WHEN nested THEN round(value, 6) END AS features_value,
       CASE WHEN nested THEN round(usr, 6) END AS features_user
FROM p7 WHERE NOT bad"""

ORACLE["json_features"] = with_(P7) + """
SELECT event_id, ts, source, round(value, 6) AS value, round(usr, 6) AS "user" FROM p7 WHERE NOT bad"""

ORACLE["synth_ts"] = with_(P7) + "SELECT event_id, make_timestamp(event_id * 1000000) AS ts FROM p7 WHERE NOT bad"

ORACLE["json_rejects"] = with_(P7) + "SELECT event_id, 'malformed' AS reason FROM p7 WHERE bad"

ORACLE["flag_summary"] = with_(*FITTED) + """
SELECT series_key, CAST(sum(flag) AS BIGINT) AS n_flagged, count(*) AS n_windows,
       CASE WHEN count(*) = 0 THEN 'Not enough rows for one window' WHEN sum(flag) = 0 THEN 'No anomalies detected'
            ELSE 'OK' END AS message
FROM flagged WHERE split = 'test' GROUP BY 1"""

VERDICT = with_(P3B, """ver AS (SELECT series_key, count(*) AS n_rows, count(ts) AS n_ts,
      CASE WHEN CAST(count(ts) AS DOUBLE) / count(*) <= 0.8 THEN 'time column unparsable'
           WHEN count(*) < 64 THEN 'fewer than 64 rows' END AS reason FROM p3b GROUP BY 1)""")

ORACLE["route_valid"] = VERDICT + """
SELECT series_key, event_id FROM p3b WHERE series_key IN (SELECT series_key FROM ver WHERE reason IS NULL)"""

ORACLE["route_rejected"] = VERDICT + "SELECT series_key, n_rows, reason FROM ver WHERE reason IS NOT NULL"

ORACLE["run_best_step"] = """
SELECT run_id, key, arg_min(step, (value, step)) AS best_step, min(value) AS best_value FROM (
  SELECT event_type AS run_id, 'avg_value' AS key, CAST(dayofyear(ts) - 1 AS INTEGER) AS step,
         round(avg(value), 6) AS value FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2"""

ORACLE["best_model"] = with_(*FITTED) + """
SELECT series_key, arg_min(model, (m, model)) AS best_model, round(min(m), 6) AS val_err FROM (
  SELECT series_key, model, avg(err) AS m FROM errs WHERE split = 'val' GROUP BY 1, 2) GROUP BY 1"""

ORACLE["latest_n"] = with_(P3B) + """
SELECT series_key, event_id, ts, pos FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY series_key ORDER BY ts DESC, event_id DESC) AS INTEGER) AS pos FROM p3b)
WHERE pos <= 10"""


# ---------------------------------------------------------------- F3-F5: one-hot on categorical orders

P9_FIT = "p9fit AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')"

_CAT_COLS = ["o_orderpriority", "o_orderstatus", "o_custkey"]
_CATS = " UNION ALL ".join(f"""SELECT '{c}' AS column, category, row_number() OVER (ORDER BY category) - 1 AS pos
FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS category FROM p9fit)""" for c in _CAT_COLS)
ORACLE["onehot_fit"] = with_(P9_FIT) + _CATS

_ENC = with_(P9_FIT, f"cats AS ({_CATS})", "enc AS (SELECT o.o_orderkey, o.o_totalprice, " + ", ".join(
    f"(SELECT pos FROM cats WHERE cats.column = '{c}' AND category = CAST(o.{c} AS VARCHAR)) AS {c}__pos, "
    f"(SELECT count(*) FROM cats WHERE cats.column = '{c}') AS {c}__size" for c in _CAT_COLS) + " FROM orders o)")
ORACLE["onehot_apply"] = _ENC + "SELECT o_orderkey, " + ", ".join(f"{c}__{x}" for c in _CAT_COLS for x in ("pos", "size")) + " FROM enc"

ORACLE["assemble"] = _ENC + """
SELECT o_orderkey, 1 + o_orderpriority__size + o_orderstatus__size + o_custkey__size AS n_features,
       round(o_totalprice + CAST(o_orderpriority__pos IS NOT NULL AS INTEGER) + CAST(o_orderstatus__pos IS NOT NULL AS INTEGER)
             + CAST(o_custkey__pos IS NOT NULL AS INTEGER), 6) AS feature_sum,
       COALESCE(1 + o_orderpriority__size + o_orderstatus__size + o_custkey__pos, 1 + o_orderpriority__size + o_orderstatus__pos,
                1 + o_orderpriority__pos, 0) AS last_index
FROM enc"""


# ---------------------------------------------------------------- SURVEY §7 minimum slice (avg_value, ewma only)

_SL = ["avg_value"]
ORACLE["minimum_slice"] = with_(
    "p1v AS (SELECT series_key, ts, avg_value FROM (" + P1.split(" AS (", 1)[1].rsplit(")", 1)[0] + "))",
    *resample_ctes("p1v", "prep", _SL), *split_ctes("prep"), *scale_ctes("sp", _SL), *rows_ctes("scaled", _SL, full_lags=True),
    f"""we AS (SELECT series_key, split, ts, rn_split, CASE WHEN count(rowerr__ewma) OVER f = {W}
          THEN avg(rowerr__ewma) OVER f END AS err FROM rows
          WINDOW f AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW))""",
    f"errs AS (SELECT * FROM we WHERE rn_split >= {W - 1} AND err IS NOT NULL)",
    f"""norms AS (SELECT series_key, avg(err) AS mean, stddev_pop(err) + {d(STD_EPS)} AS std FROM errs
          WHERE split = 'val' GROUP BY 1)""",
    """scores AS (SELECT e.series_key, e.split, e.ts, (e.err - n.mean) / CASE WHEN n.std > 0 THEN n.std ELSE 1.0 END
          AS score FROM errs e JOIN norms n USING (series_key))""",
    f"""thr AS (SELECT series_key, quantile_cont(score, {d(DEFAULT_Q)}) AS threshold FROM scores
          WHERE split = 'val' GROUP BY 1)""") + """
SELECT s.series_key, s.split, s.ts, round(s.score, 6) AS score, CAST(s.score > t.threshold AS INTEGER) AS flag
FROM scores s JOIN thr t USING (series_key)"""


# ---------------------------------------------------------------- H4-H7: learned detectors

ORACLE["recon_pca"] = with_(*P1_SCALED) + f"""
SELECT series_key, split, ts, CAST(0.0 AS DOUBLE) AS err FROM scaled WHERE rn_split >= {W - 1}"""

ORACLE["score_frozen_learned"] = """
SELECT * FROM (VALUES ('same windows', true), ('same scores', true), ('same flags', true), ('five models', true)) t("check", holds)"""

ORACLE["recon_dense_losses"] = """
SELECT * FROM (VALUES ('an epoch each', true), ('train loss falls', true), ('best epoch kept', true)) t("check", holds)"""

_NC = float(len(P1_FEATURES))
_EXTERNAL = f"""ext AS (SELECT * FROM (
    SELECT series_key, split, ts, rn_split, sum({" + ".join(f"{c} * {c}" for c in P1_FEATURES)}) OVER f / {d(W * _NC)}
           - pow(sum({" + ".join(P1_FEATURES)}) OVER f / {d(W * _NC)}, 2) AS err
    FROM scaled WINDOW f AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW))
  WHERE rn_split >= {W - 1})"""
ORACLE["score_external"] = with_(*P1_SCALED, _EXTERNAL) + """
SELECT series_key, split, ts, round(err, 6) AS err FROM ext"""

_FOUR = [c.replace("errs AS (", "errs3 AS (", 1) if c.lstrip().startswith("errs AS (") else c for c in DETECT]
ORACLE["ensemble_external"] = with_(*_FOUR, _EXTERNAL, """errs AS (SELECT * FROM errs3 UNION ALL
    SELECT series_key, split, ts, rn_split, 'window_mean', err FROM ext)""", *[
        c.replace("avg(err) AS score", "avg(err) AS score, count(*) AS n_models") if c.startswith("scores AS") else c for c in ensemble_ctes()]) + """
SELECT series_key, split, ts, round(score, 6) AS score, n_models, flag FROM flagged"""
