"""Session cut rules (time gap, pageview, or one the caller writes).

A rule decides, for two consecutive logs of the same cookie in time order,
whether the later one opens a new session.  The first log of a cookie always
opens one.  Rules are written once with plain operators (``-``, ``>=``,
``==``, ``!=``, ``&``, ``|``, ``~``) over attribute access, e.g.
``lambda cur, prev: cur.ms - prev.ms >= gap``.  Both arguments hold Spark
Columns; the same expression cuts inside a chunk and at its edges.

``inputs`` names the columns the rule reads; each maps to a Column
expression over the log row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitflow.functions.columns import log_time_ms
from visitflow.schema import DEFAULT_GAP_MS, LOG_TIME, LOG_TYPE, PAGEVIEW


@dataclass(frozen=True)
class CutRule:
    name: str
    starts: Callable[[object, object], object]
    inputs: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    # True when the rule needs a readable time: a log with a null input is malformed.
    parses_time: bool = False

    def input_columns(self) -> dict[str, Column]:
        return {name: make() for name, make in self.inputs.items()}


def _gap_ms(gap) -> int:
    if isinstance(gap, int):
        return gap
    if isinstance(gap, float):
        return int(gap)
    if isinstance(gap, str):
        amount, unit = gap.split()
        scale = {
            "ms": 1,
            "second": 1000,
            "seconds": 1000,
            "minute": 60_000,
            "minutes": 60_000,
            "hour": 3_600_000,
            "hours": 3_600_000,
            "day": 86_400_000,
            "days": 86_400_000,
        }[unit.lower()]
        return int(float(amount) * scale)
    # datetime.timedelta
    return int(gap.total_seconds() * 1000)


def time_gap_cut(gap=DEFAULT_GAP_MS) -> CutRule:
    """New session when the time since the previous log is >= ``gap`` (inclusive)."""
    gap_ms = _gap_ms(gap)

    def starts(cur, prev):
        return (cur.ms - prev.ms) >= gap_ms

    return CutRule(
        name=f"time_gap_{gap_ms}ms",
        starts=starts,
        inputs={"ms": lambda: log_time_ms(F.col(LOG_TIME), strict=False)},
        parses_time=True,
    )


def pageview_cut() -> CutRule:
    """Every pageview opens a new session; leading clicks form their own session."""

    def starts(cur, prev):
        return cur.is_pageview

    return CutRule(name="pageview", starts=starts, inputs={"is_pageview": lambda: F.col(LOG_TYPE) == PAGEVIEW})


def day_change_cut() -> CutRule:
    """Example of a caller-written rule: cut when the calendar day changes."""

    def starts(cur, prev):
        return cur.day != prev.day

    return CutRule(
        name="day_change",
        starts=starts,
        inputs={"day": lambda: F.floor(log_time_ms(F.col(LOG_TIME), strict=False) / 86_400_000)},
        parses_time=True,
    )
