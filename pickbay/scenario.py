"""Scalar parameters of one run.

The reference passes a run date, a scenario id and a scenario timestamp on the
command line and derives a handful of offsets from the date.  Here they live in
two frozen dataclasses; operators take them as arguments and never read the
wall clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class Scenario:
    """One selection / division run: partition (dt, pid, ts) plus knobs."""

    run_date: _dt.date
    pid: str
    ts: str
    dc_id: str | None = None
    # Fixed values of the business rules (defaults of the reference jobs).
    share_bonus: float = 0.15  # target share = min(share_bonus + ratio, 1)
    recent_bonus: int = 4  # extra votes for a pick in the last `recent_days`
    recent_days: int = 3
    transfer_days: int = 30
    history_days: int = 31  # days written by one ingestion run
    retention_days: int = 4  # ingestion partitions older than this are dropped
    store_thresholds: tuple[int, int] = (18, 16)  # votes needed, 1st / 2nd store
    joint_threshold: int = 0
    cover_share: float = 0.2  # share of the orders that a coverage selection holds whole

    def __post_init__(self):
        object.__setattr__(self, "run_date", _as_date(self.run_date))

    @property
    def partition(self) -> dict:
        """The output partition of the run."""
        return {"dt": self.run_date.isoformat(), "pid": self.pid, "ts": self.ts}

    @property
    def yesterday(self) -> _dt.date:
        return self.run_date - _dt.timedelta(days=1)

    @property
    def recent_start(self) -> _dt.date:
        return self.run_date - _dt.timedelta(days=self.recent_days)

    @property
    def transfer_start(self) -> _dt.date:
        return self.run_date - _dt.timedelta(days=self.transfer_days)

    @property
    def history_start(self) -> _dt.date:
        return self.run_date - _dt.timedelta(days=self.history_days)

    @property
    def retention_cutoff(self) -> _dt.date:
        return self.run_date - _dt.timedelta(days=self.retention_days)


@dataclass(frozen=True)
class PurchaseWindow:
    """Purchase wide-table run: `end_date` and a look-back of `days`."""

    end_date: _dt.date
    days: int = 90
    default_lead_days: int = 10  # lead time used when no stock-out row exists

    def __post_init__(self):
        object.__setattr__(self, "end_date", _as_date(self.end_date))

    @property
    def start_date(self) -> _dt.date:
        return self.end_date - _dt.timedelta(days=self.days)

    @property
    def end_text(self) -> str:
        return self.end_date.isoformat()

    @property
    def start_text(self) -> str:
        return self.start_date.isoformat()
