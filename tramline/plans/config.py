"""Engine parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Durations in milliseconds of event time, unless a name says otherwise."""

    window: int = 300_000
    lateness: int = 120_000
    out_of_order: int = 30_000
    dedup_retention: int = 120_000
    lookback: int = 7_200_000
    early_seconds: int = -60
    on_time_seconds: int = 300
    wait_rows: int = 1000
    wait_deadline: int = 60_000
    wait_retry: int = 1_000
    #: Into so many lots a stream deals its rows; each has a state of its own.
    lots: int = 256


#: The window key; a route key is the same without the window.
ROUTE_KEY = ["agency_id", "route_id", "direction_id", "service_date"]
WINDOW_KEY = [*ROUTE_KEY, "window_start"]
