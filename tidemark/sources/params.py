"""Every 'now' is a parameter."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class AsOf:
    """The day that windows end on; day 0:00 where an instant is asked for."""

    day: date = date(2001, 7, 15)

    @property
    def month_before(self) -> date:
        """The same day a calendar month earlier, or the last of a shorter month."""
        y, m = (self.day.year, self.day.month - 1) if self.day.month > 1 else (self.day.year - 1, 12)
        last = (date(y + m // 12, m % 12 + 1, 1) - timedelta(days=1)).day
        return date(y, m, min(self.day.day, last))

    @property
    def days_30(self) -> date:
        return self.day - timedelta(days=30)

    @property
    def active_month(self) -> str:
        """'YYYY-MM' from which a merchant counts as active: the whole previous calendar month and on."""
        return self.month_before.strftime("%Y-%m")

    @property
    def year_start(self) -> date:
        return date(self.day.year, 1, 1)

    @property
    def next_year(self) -> date:
        return date(self.day.year + 1, 1, 1)


#: Month from which diagnostics count activity; the driver's orders end in 2001.
DIAGNOSTICS_FLOOR = "2001-01"
