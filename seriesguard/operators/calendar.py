"""Calendar frequencies for D6-D10: which rule a series follows, and where the rule's points lie.

A rule is a unit and a step: ``us`` (a fixed number of microseconds), ``month`` (every n-th month, at a position inside it) or
``bday`` (every n-th weekday). Its points are numbered: ``with_point`` gives the k-th one from the series' base, ``with_first_at``
the number of the first point at or after a time. Both are columns computed from a series' parameters (columns that start
with ``_g_``), so grids of all kinds are exploded and filled by the same plan, and no list of dates is ever made.

Rules are inferred from per-series aggregates: steps of months and years, whether every row lies at a month's start or
end (of the calendar or of business days), weekdays and weeks of the month. Names are the usual aliases, such as ``ME``,
``2QS-OCT``, ``W-MON``, ``B``, ``WOM-2TUE``, ``15min``.

Expressions are SQL text, and columns that are used several times are built in steps of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesguard.functions.columns import q

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
#: The Monday from which weekdays are counted, as days since the epoch.
MONDAY = 4
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]
# Fixed values, the usual frequency aliases: name of the kind, months of the unit, position in the month.
MONTH_RULES = {
    "YE": ("year_end", 12, "ce"), "YS": ("year", 12, "cs"), "BYE": ("business_year_end", 12, "be"), "BYS": ("business_year", 12, "bs"),
    "QE": ("quarter_end", 3, "ce"), "QS": ("quarter", 3, "cs"), "BQE": ("business_quarter_end", 3, "be"), "BQS": ("business_quarter", 3, "bs"),
    "ME": ("month_end", 1, "ce"), "MS": ("month", 1, "cs"), "BME": ("business_month_end", 1, "be"), "BMS": ("business_month", 1, "bs"),
    "WOM": ("week_of_month", 1, "wom"),
}
FIXED_US = {"D": DAY_US, "h": HOUR_US, "min": 60_000_000, "s": 1_000_000, "ms": 1000, "us": 1}


def _with(df: DataFrame, *steps: dict[str, str]) -> DataFrame:
    """Columns from SQL text; a step can use the columns of those before."""
    for step in steps:
        df = df.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return df


def _case(column: str, values: dict[str, object]) -> str:
    """SQL that looks a text up."""
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {column} {whens} END"


def _month(t: str) -> str:
    """Months since the year 0."""
    return f"CAST(year({t}) * 12 + month({t}) - 1 AS BIGINT)"


def _with_date(df: DataFrame, month: str, out: str) -> DataFrame:
    """``out``: the day (midnight, microseconds) at the grid's position in a month: ``cs``, ``ce`` first and last day, ``bs``, ``be`` first and
    last weekday, ``wom`` the ``week``-th (from 1) weekday ``wd`` (0 Monday)."""
    shift = lambda day, sat, sun: f"date_add({day}, CASE weekday({day}) WHEN 5 THEN {sat} WHEN 6 THEN {sun} ELSE 0 END)"
    return _with(
        df, {"_c_first": f"CASE WHEN _g_pos IS NOT NULL THEN make_date(CAST(floor({month} / 12) AS INT), CAST(pmod({month}, 12) + 1 AS INT), 1) END"},
        {"_c_last": "last_day(_c_first)"},
        {out: f"""unix_date(CASE _g_pos WHEN 'cs' THEN _c_first WHEN 'ce' THEN _c_last WHEN 'bs' THEN {shift('_c_first', 2, 1)}
                 WHEN 'be' THEN {shift('_c_last', -1, -2)}
                 WHEN 'wom' THEN date_add(_c_first, CAST(pmod(_g_wd - weekday(_c_first), 7) + (_g_week - 1) * 7 AS INT)) END) * {DAY_US}L"""},
    ).drop("_c_first", "_c_last")


def with_point(df: DataFrame, k: str, out: str) -> DataFrame:
    """``out``: microseconds of point ``k``; calendar points lie at midnight."""
    df = _with_date(_with(df, {"_c_at": f"_g_base + {k} * _g_step"}), "_c_at", "_c_date")
    return _with(df, {out: f"""CAST(CASE _g_unit WHEN 'us' THEN _c_at WHEN 'month' THEN _c_date
                              ELSE ({MONDAY} + floor(_c_at / 5) * 7 + pmod(_c_at, 5)) * {DAY_US}L END AS BIGINT)"""}).drop("_c_at", "_c_date")


def _bday_at(us: str) -> str:
    """Number of the first weekday whose date is that of ``us`` or later."""
    since = f"(floor({us} / {DAY_US}) - {MONDAY})"
    return f"(floor({since} / 7) * 5 + least(pmod({since}, 7), 5))"


def with_first_at(df: DataFrame, us: str, out: str) -> DataFrame:
    """``out``: number of the first point at or after ``us``."""
    df = _with(df, {"_c_of": f"CASE _g_unit WHEN 'us' THEN {us} WHEN 'month' THEN {_month(f'timestamp_micros({us})')} ELSE {_bday_at(us)} END"},
               {"_c_near": "CAST(ceil((_c_of - _g_base) / _g_step) AS BIGINT)"})
    df = with_point(df, "_c_near", "_c_point")  # the point of that month or day may lie before the time
    return _with(df, {out: f"_c_near + IF(_c_point < {us}, 1, 0)"}).drop("_c_of", "_c_near", "_c_point")


# ---------------------------------------------------------------- inference

def step_columns(ts: str, delta_us: str = "delta_us") -> list[Column]:
    """Aggregates of the rows with one step, from which ``with_rule`` infers the rule."""
    t = q(ts)
    prev = f"timestamp_micros(unix_micros({t}) - {delta_us})"
    day, last, wd = f"dayofmonth({t})", f"dayofmonth(last_day({t}))", f"weekday({t})"
    spans = {"md": f"{_month(t)} - {_month(prev)}", "yd": f"year({t}) - year({prev})", "month": f"month({t})", "wd": wd,
             "week": f"CASE WHEN {day} <= 28 THEN ({day} + 6) div 7 END"}
    all_of = {"cs": f"{day} = 1", "bs": f"{day} = 1 OR ({day} <= 3 AND {wd} = 0)", "ce": f"{day} = {last}",
              "be": f"{day} = {last} OR ({last} - {day} < 3 AND {wd} = 4)",
              "bday": f"{delta_us} IS NULL OR ({wd} = 0 AND {delta_us} = {3 * DAY_US}) OR ({wd} BETWEEN 1 AND 4 AND {delta_us} = {DAY_US})"}
    return [*[F.expr(f"{m}({sql}) AS {m}_{n}") for n, sql in spans.items() for m in ("min", "max")],
            *[F.expr(f"bool_and({sql}) AS {n}") for n, sql in all_of.items()]]


def merged_steps() -> list[Column]:
    """``step_columns`` of all steps of a series."""
    return [*[F.expr(f"{m}({m}_{n}) AS {m}_{n}") for n in ("md", "yd", "month", "wd", "week") for m in ("min", "max")],
            *[F.expr(f"bool_and({n}) AS {n}") for n in ("cs", "bs", "ce", "be", "bday")]]


def with_rule(series: DataFrame) -> DataFrame:
    """Adds ``rule`` (alias without count; null if none), ``rule_n`` (units of a step) and ``anchor`` to rows of ``merged_steps`` with ``n_rows``,
    ``n_steps``, ``min_step``, ``max_step`` and ``sum_steps`` (of the different steps).

    Rules are tried in this order: year, quarter, month, one fixed step, business day, week of month; where the smallest step
    isn't whole days: business hour, one fixed step. At least 3 rows and a positive step are needed."""
    units = {"W": 7 * DAY_US, **FIXED_US}
    fixed = "CASE " + " ".join(f"WHEN min_step % {us} = 0 THEN '{name}'" for name, us in units.items()) + " END"
    name = lambda unit: f"concat(IF(left(_c_pos, 1) = 'B', 'B', ''), '{unit}', right(_c_pos, 1))"
    at = lambda names, i: f"element_at(array({', '.join(map(repr, names))}), CAST({i} AS INT))"
    month = "_c_pos IS NOT NULL AND min_md = max_md AND min_md > 0"
    return _with(
        series, {"_c_pos": "CASE WHEN ce THEN 'E' WHEN be THEN 'BE' WHEN cs THEN 'S' WHEN bs THEN 'BS' END"},
        {"rule": f"""CASE WHEN n_rows < 3 OR min_step <= 0 THEN NULL
            WHEN min_step % {DAY_US} = 0 THEN CASE
              WHEN _c_pos IS NOT NULL AND min_yd = max_yd AND min_yd > 0 AND min_month = max_month THEN {name('Y')}
              WHEN {month} AND min_md % 3 = 0 THEN {name('Q')} WHEN {month} THEN {name('M')} WHEN n_steps = 1 THEN {fixed}
              WHEN n_steps = 2 AND min_step = {DAY_US} AND max_step = {3 * DAY_US} AND bday THEN 'B'
              WHEN min_wd = max_wd AND min_week = max_week THEN 'WOM' END
            WHEN min_step = {HOUR_US} AND (n_steps = 2 AND max_step IN ({17 * HOUR_US}, {65 * HOUR_US})
              OR n_steps = 3 AND max_step = {65 * HOUR_US} AND sum_steps = {83 * HOUR_US}) THEN 'bh'
            WHEN n_steps = 1 THEN {fixed} END"""},
        {"rule_n": f"""CAST(CASE WHEN rule RLIKE 'Y[ES]$' THEN min_yd WHEN rule RLIKE 'Q[ES]$' THEN min_md / 3 WHEN rule RLIKE 'M[ES]$' THEN min_md
            WHEN rule IN {tuple(units)} THEN min_step / {_case('rule', units)} WHEN rule IS NOT NULL THEN 1 END AS BIGINT)""",
         "anchor": f"""CASE WHEN rule RLIKE 'Y[ES]$' THEN {at(MONTHS, 'min_month')}
            WHEN rule RLIKE 'Q[ES]$' THEN {at(['DEC', 'OCT', 'NOV'], 'min_month % 3 + 1')}
            WHEN rule = 'W' THEN {at(WEEKDAYS, 'min_wd + 1')} WHEN rule = 'WOM' THEN concat(min_week, {at(WEEKDAYS, 'min_wd + 1')}) END"""},
    ).drop("_c_pos")


def alias_of() -> Column:
    """The rule's full name, such as ``2QS-OCT``."""
    return F.expr("concat(IF(rule_n > 1, CAST(rule_n AS STRING), ''), rule, coalesce(concat('-', anchor), ''))")


def kind_of() -> Column:
    kinds = {**{n: "fixed" for n in (*FIXED_US, "W")}, "B": "business_day", "bh": "business_hour", **{n: v[0] for n, v in MONTH_RULES.items()}}
    return F.expr(_case("rule", kinds))


def parse_rule(freq: str) -> tuple[str, int, str | None]:
    """``(rule, count, anchor)`` of an alias; quarters and years without an anchor end in December (start in January), weeks end on Sunday."""
    m = re.fullmatch(r"(\d*)([A-Za-z]+)(?:-([0-9A-Z]+))?", freq)
    rule, anchor = (m[2], m[3]) if m else (None, None)
    if rule not in MONTH_RULES and rule not in FIXED_US and rule not in ("W", "B"):
        raise ValueError(f"unknown frequency: {freq}")
    fits = (anchor in WEEKDAYS if rule == "W" else re.fullmatch(f"[1-4]({'|'.join(WEEKDAYS)})", anchor or "") if rule == "WOM"
            else anchor in MONTHS if rule[-2:] in ("YE", "YS", "QE", "QS") else False)
    if rule == "WOM" and not fits or anchor is not None and not fits:
        raise ValueError(f"unknown anchor of a frequency: {freq}")
    if anchor is None and rule[-2:] in ("YE", "QE", "YS", "QS"):
        anchor = "DEC" if rule.endswith("E") else "JAN"
    return rule, int(m[1] or 1), anchor or ("SUN" if rule == "W" else None)


def with_grid(series: DataFrame, forward: bool = False) -> DataFrame:
    """Adds the ``_g_`` columns of each series' grid to ``rule``, ``rule_n``, ``anchor``, ``freq_us`` and ``min_us``; ``_g_right``: points close
    the time before them.

    The base is where resampling begins: midnight of the first day for fixed steps, the rule's last point at or before
    the first day for rules at starts, its first point from that day on for rules at ends and weeks. With ``forward`` it is
    the first point from the first row's day on (for fixed steps the first row), where an expected range begins."""
    months, pos = ({k: v[i] for k, v in MONTH_RULES.items()} for i in (1, 2))
    index = lambda names, name: f"array_position(array({', '.join(map(repr, names))}), {name}) - 1"
    ahead = "true" if forward else "_g_right"
    df = _with(
        series, {"_c_day": f"CAST(floor(min_us / {DAY_US}) AS BIGINT) * {DAY_US}L", "_c_months": _case("rule", months), "_g_pos": _case("rule", pos),
                 "_g_unit": f"CASE WHEN rule IN {tuple(MONTH_RULES)} THEN 'month' WHEN rule = 'B' THEN 'bday' ELSE 'us' END",
                 "_g_week": "CASE WHEN rule = 'WOM' THEN CAST(left(anchor, 1) AS INT) END",
                 "_g_wd": f"CASE WHEN rule IN ('WOM', 'W') THEN CAST({index(WEEKDAYS, 'right(anchor, 3)')} AS INT) END",
                 "_g_right": "coalesce(rule RLIKE '[YQM]E$' OR rule = 'W', false)"},
        {"_c_month": _month("timestamp_micros(_c_day)"), "_c_wd": f"CAST(pmod(_c_day div {DAY_US}L - {MONDAY}, 7) AS INT)",
         "_c_phase": f"CASE WHEN _c_months > 1 THEN {index(MONTHS, 'anchor')} ELSE 0 END"},
        {"_c_floor": "_c_month - pmod(_c_month - _c_phase, _c_months)"})
    df = _with_date(df, "_c_floor", "_c_here")
    early = f"CASE WHEN {ahead} AND _c_here < _c_day THEN _c_months WHEN NOT {ahead} AND _c_here > _c_day THEN -_c_months ELSE 0 END"
    bdays = _bday_at("_c_day") + ("" if forward else " - IF(_c_wd > 4, 1, 0)")
    df = _with(df, {
        "_g_step": "CAST(CASE _g_unit WHEN 'month' THEN rule_n * _c_months WHEN 'bday' THEN rule_n ELSE freq_us END AS BIGINT)",
        "_g_base": f"""CAST(CASE _g_unit WHEN 'month' THEN _c_floor + {early} WHEN 'bday' THEN {bdays}
                      ELSE CASE WHEN rule = 'W' THEN _c_day + pmod(_g_wd - _c_wd, 7) * {DAY_US}L ELSE {'min_us' if forward else '_c_day'} END END AS BIGINT)"""})
    return df.drop("_c_day", "_c_months", "_c_month", "_c_wd", "_c_phase", "_c_floor", "_c_here")
