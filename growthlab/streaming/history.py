"""The rolling features of a platform's newest complete bucket, from bounded state.

State per platform is what the features can ask for and no more: the last `season` buckets, the newest one that is
still filling, and the last few buckets of every hour of the week. A trigger reads new buckets only."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from growthlab.operators.timeseries import FEATURES, Spans

# executors need not have this package installed: ship its few functions with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "hours array<bigint>, approved array<bigint>, total array<bigint>, week_hour array<int>, rates array<double>, totals array<double>, n bigint"
RECORD = (
    "platform string, hour timestamp, max_hour_excluded timestamp, records_analyzed bigint, hour_of_week int, "
    "success_factor double, volume_factor double, rolling_7day_avg_success double, "
    + ", ".join(f"{c} double" for c in FEATURES)
)
_HOUR = 3_600_000_000


def hour_of_week(micros: int) -> int:
    """0 = Monday 00h (UTC) ... 167; the first day of the epoch was a Thursday."""
    return (micros // _HOUR + 72) % 168


def _or(x: float, zero: float) -> float:
    """Divisors of zero are replaced."""
    return zero if x == 0 else x


def _clip(x: float, low: float = 0.1, high: float = 5.0) -> float:
    return min(max(x, low), high)


@dataclass
class History:
    """Buckets of one platform in order; the last one is still filling."""

    spans: Spans
    hours: list[int] = field(default_factory=list)
    approved: list[int] = field(default_factory=list)
    total: list[int] = field(default_factory=list)
    #: hour of the week -> (rate, total) of its last complete buckets
    by_hour: dict[int, list[tuple[float, float]]] = field(default_factory=dict)
    n: int = 0

    @staticmethod
    def of(spans: Spans, stored: tuple | None) -> History:
        if stored is None:
            return History(spans)
        hours, approved, total, week_hour, rates, totals, n = stored
        by_hour: dict[int, list] = {}
        for h, r, t in zip(week_hour, rates, totals):
            by_hour.setdefault(h, []).append((r, t))
        return History(spans, list(hours), list(approved), list(total), by_hour, n)

    def stored(self) -> tuple:
        flat = [(h, r, t) for h, pairs in sorted(self.by_hour.items()) for r, t in pairs]
        week_hour, rates, totals = ([x[k] for x in flat] for k in range(3))
        return self.hours, self.approved, self.total, week_hour, rates, totals, self.n

    def add(self, hour: int, approved: int, total: int) -> None:
        """The next bucket; the one before it is now complete."""
        if self.hours:
            if hour <= self.hours[-1]:
                raise ValueError("buckets must come in order")
            last = self.by_hour.setdefault(hour_of_week(self.hours[-1]), [])
            last.append((self.approved[-1] / _or(self.total[-1], 1), float(self.total[-1])))
            del last[: -self.spans.same_hour]
            self.n += 1
        for values, x in ((self.hours, hour), (self.approved, approved), (self.total, total)):
            values.append(x)
            del values[: -self.spans.season - 1]

    def record(self) -> dict:
        """The newest complete bucket's features; NULL where there are too few buckets."""
        out = dict.fromkeys(x.split()[0] for x in RECORD.split(", "))
        out |= {"max_hour_excluded": pd.Timestamp(self.hours[-1], unit="us"), "records_analyzed": self.n}
        if self.n == 0 or self.n < self.spans.least_rows:
            return out
        s, hours = self.spans, np.array(self.hours[:-1])
        approved, total = np.array(self.approved[:-1], dtype=float), np.array(self.total[:-1], dtype=float)
        rate = approved / np.where(total == 0, 1, total)
        now = hour_of_week(int(hours[-1]))
        season = np.array([hour_of_week(int(h)) == now for h in hours])
        factors = []
        for x in (rate, total):
            whole = x.mean()
            factors.append(_clip(x[season].mean() / whole, 0.3, 3.0) if whole else 1.0)
        enough = min(self.n, s.week) >= s.week_least
        week_rate, week_total = rate[-s.week :].mean(), total[-s.week :].mean()
        same = self.by_hour[now]
        same_rate, same_total = np.mean(same, axis=0) if len(same) >= 2 else (week_rate, week_total)

        def four(end: int) -> tuple[float, float]:
            part = slice(max(0, end - s.hour), end)
            return approved[part].sum() / _or(total[part].sum(), 1), total[part].sum()

        rate4, total4 = four(len(rate))
        back = len(rate) - s.week
        before = len(total) - 1 - s.hour
        rate12, total12 = rate[-s.three_hours :], total[-s.three_hours :]
        spread = lambda x: float(x.std(ddof=1)) if len(x) >= 2 else 0.0
        trend = float(np.polyfit(np.arange(len(rate12)), rate12, 1)[0]) if len(rate12) >= 3 else 0.0
        if before < 0:
            momentum = 0.0
        elif total[before]:
            momentum = total[-1] / total[before] - 1
        else:
            momentum = 1.0 if total[-1] > 0 else 0.0
        values = [
            _clip(rate4 / _or(same_rate * factors[0], 0.5)),
            _clip(total4 / _or(same_total * factors[1] * 4, 10.0)),
            _clip(rate[-1] / _or(week_rate, 0.5)) if enough else None,
            _clip(total[-1] / _or(week_total, 10.0)) if enough else None,
            rate[-1] / _or(rate[-s.hour :].mean(), 1.0),
            total[-1] / _or(total12.mean(), 1.0),
            rate12.mean(),
            rate4 / _or(four(back)[0], 1.0) if back > 0 else 1.0,
            spread(rate12),
            spread(total12),
            trend,
            momentum,
        ]
        return out | dict(zip(FEATURES, values)) | {
            "hour": pd.Timestamp(int(hours[-1]), unit="us"), "hour_of_week": now, "success_factor": factors[0],
            "volume_factor": factors[1], "rolling_7day_avg_success": week_rate if enough else None,
        }


def newest_features(counts: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """Per trigger one record for each platform with new buckets, from a stream of (platform, hour, approved, total) that
    brings a platform's buckets in order of time (as finished windows come). Features equal those of the newest complete
    bucket of the whole series; `least_rows` must be at least `week_least`, so that none of them lacks its baseline."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history = History.of(spans, state.get if state.exists else None)
        rows = pd.concat(list(frames)).sort_values("hour")
        micros = rows["hour"].astype("datetime64[us]").astype("int64")
        for hour, approved, total in zip(micros, rows["approved"], rows["total"]):
            history.add(int(hour), int(approved), int(total))
        state.update(history.stored())
        yield pd.DataFrame([history.record() | {"platform": key[0]}])

    rows = counts.select("platform", "hour", "approved", "total")
    return rows.groupBy("platform").applyInPandasWithState(run, RECORD, STATE, "append", GroupStateTimeout.NoTimeout)
