"""Where everything lies below one base folder."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths of the buffer, the quarantine, the tables and the stream state."""

    base: str

    def _below(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def buffer(self) -> str:
        return self._below("nrt")

    @property
    def dead_letters(self) -> str:
        return self._below("dead_letter/nrt")

    @property
    def raw_nrt(self) -> str:
        return self._below("raw/raw_nrt")

    @property
    def raw_batch(self) -> str:
        return self._below("raw/raw_batch")

    @property
    def report_errors(self) -> str:
        return self._below("raw/report_errors")

    @property
    def manifest(self) -> str:
        return self._below("raw/loaded_files")

    @property
    def edits_hourly(self) -> str:
        return self._below("marts/edits_hourly")

    @property
    def ledger(self) -> str:
        return self._below("state/edits_hourly")

    @property
    def landing_checkpoint(self) -> str:
        return self._below("state/landing")

    @property
    def flushes(self) -> str:
        return self._below("state/flushes")

    @property
    def horizon(self) -> str:
        return self._below("state/horizon")

    @property
    def expired_deliveries(self) -> str:
        return self._below("raw/expired_deliveries")

    @property
    def dirty_hours(self) -> str:
        return self._below("state/dirty_hours")

    @property
    def planned_loads(self) -> str:
        return self._below("state/planned_loads")

    @property
    def seen_files(self) -> str:
        return self._below("state/seen_files")

    @property
    def seen_reports(self) -> str:
        return self._below("state/seen_reports")

    def violations(self, rule: str) -> str:
        return self._below(f"checks/{rule}")

    def buffer_partition(self, day: dt.date) -> str:
        return f"{self.buffer}/dt={day.isoformat()}"

    def dead_letter_partition(self, day: dt.date) -> str:
        return f"{self.dead_letters}/dt={day.isoformat()}"
