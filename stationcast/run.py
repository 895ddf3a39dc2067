"""The run context every layer is stamped with; always passed in, never read from the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone


@dataclass(frozen=True)
class RunContext:
    run_date: date
    loaded_at: datetime

    @property
    def run_date_id(self) -> int:
        return int(self.run_date.strftime("%Y%m%d"))

    @property
    def load_time_id(self) -> int:
        stamp = self.loaded_at
        if stamp.tzinfo is None:
            stamp = stamp.replace(tzinfo=timezone.utc)
        return int(stamp.timestamp())


def at(run_date: str, loaded_at: str | None = None) -> RunContext:
    """Build a context from ISO text: ``at("2024-01-31", "2024-01-31T06:00:00")``."""
    day = date.fromisoformat(run_date)
    stamp = datetime.fromisoformat(loaded_at) if loaded_at else datetime(day.year, day.month, day.day)
    return RunContext(day, stamp)
