"""Run configuration."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

from siftworks.functions.periods import MONTH_TEXT


@dataclass(frozen=True)
class JobConfig:
    """What to keep, what to trust and how strict the price fences are.

    ``registration_from`` is the first month whose date means registration
    rather than approval.
    """

    start_month: str = "2012-01"
    end_month: str = "2016-12"
    reference_month: str = "2012-01"
    lease_years: int = 99
    anomaly_min_peers: int = 20
    anomaly_iqr_multiplier: float = 3.0
    registration_from: str = "2012-03"

    def __post_init__(self) -> None:
        months = {
            name: getattr(self, name)
            for name in ("start_month", "end_month", "reference_month", "registration_from")
        }
        bad = {name: value for name, value in months.items() if not re.fullmatch(MONTH_TEXT, value)}
        if bad:
            raise ValueError(f"Months must look like YYYY-MM: {bad}")
        if self.reference_month < self.start_month or self.reference_month > self.end_month:
            raise ValueError("The reference month lies outside the requested period")
        if self.lease_years < 1:
            raise ValueError("lease_years must be positive")
        if self.anomaly_min_peers < 4:
            raise ValueError("anomaly_min_peers must be at least 4")
        if not self.anomaly_iqr_multiplier > 0:
            raise ValueError("anomaly_iqr_multiplier must be positive")

    @property
    def term_months(self) -> int:
        return 12 * self.lease_years

    def as_dict(self) -> dict:
        return asdict(self)
