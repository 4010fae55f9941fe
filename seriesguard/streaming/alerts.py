"""K5-K10 on a stream: alert rules over live metric samples, with a state machine for each label set.

Samples are paired with frozen references and judged by the rules in stream-static joins (``operators.drift``); then
``groupBy(model_version).transformWithStateInPandas`` keeps, for each alert and label set, the last sample and the run of equal
conditions that it belongs to: inactive, pending since its first tick, or firing once it has held for the rule's time. A gauge keeps
its value until the next sample, so a run goes on while other samples of its model version show that time passes, and
messages equal ``alert_messages`` of the same samples, however they are cut into batches. With ``live`` timers on the clock
let an alert fire also when no further sample comes.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from seriesguard.operators import drift
from seriesguard.streaming.stream import ROCKS

LABEL = ["alert", "feature", "env"]
OUT_SCHEMA = ("alert string, feature string, model_version string, env string, severity string, summary string, status string, "
              "since_us long, at_us long")
NAMES = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
#: The last sample of a label set (time, value, condition) and the run of conditions up to it.
STATE = "us long, live double, active boolean, hold_s int, severity string, summary string, run_active boolean, run_us long, fired boolean"


class _Alerts(StatefulProcessor):
    """All label sets of one model version: ``sets`` by label, ``end`` (the newest sample) and its timer."""

    def __init__(self, tick_us: int, live: bool):
        self.tick_us, self.live = tick_us, live

    def init(self, handle) -> None:
        self.handle = handle
        self.sets = handle.getMapState("sets", "alert string, feature string, env string", STATE)
        self.end = handle.getValueState("end", "us long, timer_ms long")

    def close(self) -> None:
        pass

    def _up(self, us: int) -> int:
        return -(-us // self.tick_us) * self.tick_us

    def _held(self, run_us: int, hold_s: int) -> int:
        return self._up(run_us + hold_s * 1_000_000)

    def _advance(self, label: tuple, s: list, last: int) -> tuple | None:
        """The last sample holds up to ``last``: its run goes on or begins, and may fire. Returns a message."""
        us, _, active, hold_s, severity, summary, run_active, run_us, fired = s
        first, last = self._up(us), last // self.tick_us * self.tick_us
        if first > last:
            return None  # no tick saw this sample
        if run_active is None or run_active != active:
            run_active, run_us, fired = active, first, False
        message = None
        if run_active and not fired and self._held(run_us, hold_s) <= last:
            fired, message = True, (*label, severity, summary, "firing", run_us, self._held(run_us, hold_s))
        s[6:] = [run_active, run_us, fired]
        return message

    def _frame(self, version: str, found: list[tuple]) -> Iterator[pd.DataFrame]:
        if found:
            rows = [(a, f, version, e, *rest) for a, f, e, *rest in found]
            yield pd.DataFrame(rows, columns=NAMES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end, timer = self.end.get() if self.end.exists() else (None, None)
        samples: dict[tuple, dict[int, tuple]] = {}
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                end = r.us if end is None else max(end, r.us)
                if isinstance(r.alert, str):
                    own = samples.setdefault((r.alert, r.feature, r.env), {})
                    if r.us not in own or r.live > own[r.us][1]:  # of samples at one time the largest counts
                        own[r.us] = (int(r.us), float(r.live), bool(r.active), int(r.hold_s), r.severity, r.summary)
        known = {tuple(k): list(v) for k, v in self.sets.iterator()}
        found, changed = [], {}
        for label, own in samples.items():
            s = known.get(label)
            for us in sorted(own):
                new = own[us]
                if s is not None and us < s[0]:
                    found.append((*label, new[4], new[5], "late", None, us))
                    continue
                if s is not None and us == s[0]:
                    if new[1] > s[1]:
                        s[:6] = new
                    continue
                if s is not None and (message := self._advance(label, s, us - 1)):
                    found.append(message)
                s = [*new, *(s[6:] if s else (None, None, False))]
            known[label] = changed[label] = s
        for label, s in known.items():
            before = s[6:]
            if message := self._advance(label, s, end):
                found.append(message)
            if s[6:] != before:
                changed[label] = s
        for label, s in changed.items():
            self.sets.updateValue(label, tuple(s))
        self.end.update((int(end), self._timer(known, timer)))
        yield from self._frame(key[0], found)

    @staticmethod
    def _may_fire(s: list) -> bool:
        """The last sample is over the limit, and its run (which no tick may have seen yet) hasn't fired."""
        return s[2] and not (s[6] and s[8])

    def _timer(self, known: dict, timer: int | None) -> int | None:
        """On a live stream: the clock time at which the next pending alert has held long enough."""
        if not self.live:
            return None
        if timer is not None:
            self.handle.deleteTimer(timer)
        due = [self._held(s[7] if s[6] else self._up(s[0]), s[3]) // 1000 + 1 for s in known.values() if self._may_fire(s)]
        if not due:
            return None
        at = max(min(due), int(time.time() * 1000) + 1)
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, _ = self.end.get()
        now = max(end, int(time.time() * 1e6))
        known = {tuple(k): list(v) for k, v in self.sets.iterator()}
        found = []
        for label, s in known.items():
            if self._may_fire(s):
                if message := self._advance(label, s, now):
                    found.append(message)
                self.sets.updateValue(label, tuple(s))
        self.end.update((end, self._timer(known, None)))
        yield from self._frame(key[0], found)


def alert_stream(samples: DataFrame, reference: DataFrame, rules: DataFrame | None = None, mode: str = "guarded", tick_us: int = drift.TICK_US,
                 live: bool = False) -> DataFrame:
    """Messages of live samples (a stream with ``metric, feature, model_version, env, ts, value``) against reference samples (a table).

    Columns of ``alert_messages`` and ``status``: ``firing``, or ``late`` for a sample older than the last one of its label set (``fired_at`` is then its
    time); samples of a label set have to come in the order of their times. With ``live`` timers run on the clock. The
    session's state store becomes RocksDB, which keyed state needs."""
    spark = samples.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = samples.where(F.col("metric").endswith("_live"))
    judged = drift.evaluate_rules(drift._paired(rows, reference), rules if rules is not None else drift.rules_table(spark), mode, reference)
    judged = judged.select("model_version", F.unix_micros("ts").alias("us"), "alert", "feature", "env", "live", "active", "hold_s", "severity", "summary")
    none = lambda c: F.lit(None).cast(judged.schema[c].dataType).alias(c)
    clock = rows.select("model_version", F.unix_micros("ts").alias("us"), *[none(c) for c in judged.columns[2:]])
    out = judged.unionByName(clock).groupBy("model_version").transformWithStateInPandas(
        _Alerts(tick_us, live), OUT_SCHEMA, "Append", "ProcessingTime" if live else "None")
    text = F.replace(F.replace("summary", F.lit("{model_version}"), F.col("model_version")), F.lit("{feature}"), F.col("feature"))
    return out.select("alert", "feature", "model_version", "env", "severity", F.timestamp_micros("since_us").alias("active_since"),
                      F.timestamp_micros("at_us").alias("fired_at"), text.alias("message"), "status")
