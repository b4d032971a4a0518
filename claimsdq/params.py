"""Run parameters: thresholds, value domains and the clock.

Nothing here reads the wall clock, and no date is a default: a job sets its
clock from the one timestamp of its run (``at``), tests and fixtures name
theirs.  An operator that needs a date refuses parameters without one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class DQParams:
    # Fixed values that must equal the reference's for equal results:
    # rule thresholds, value domains, patterns, the z-score cut-off.
    min_claim_amount: float = 0.0
    max_claim_amount: float = 100000.0
    npi_length: int = 10
    max_days_to_submission: int = 365
    future_date_tolerance_days: int = 0
    max_null_rate: float = 0.05
    valid_statuses: tuple[str, ...] = ("PAID", "DENIED", "PENDING")
    valid_genders: tuple[str, ...] = ("M", "F", "U")
    npi_pattern: str = "^[0-9]{10}$"
    zip_pattern: str = "^[0-9]{5}(-[0-9]{4})?$"
    z_threshold: float = 3.0

    # Stats scope: the columns that key one z-score group.  A batch run
    # uses the code alone; the per-file stream adds source_file.
    stats_keys: tuple[str, ...] = ("cpt_code",)

    # Clock: the day of rule R9, the end of metric look-back windows and the
    # day after the last cost day; all UTC.
    as_of: dt.date | None = None
    as_of_ts: dt.datetime | None = None
    cost_as_of: dt.date | None = None

    # Alarms (fixed values of the alarm definitions).
    anomaly_threshold: float = 100.0
    score_threshold: float = 85.0
    score_periods: int = 2
    cost_threshold: float = 2.0
    period_seconds: int = 3600

    # Dashboard constants (fixed values).
    score_target: float = 95.0
    score_band_low: float = 80.0
    monthly_budget: float = 1500.0
    fallback_daily_cost: float = 0.02

    # Remediation: a file is flagged when its gold-based score is below this.
    quarantine_score_below: float = 85.0

    # Names.
    project: str = "claims"
    environment: str = "dev"
    dq_namespace: str = "ClaimsDQ/DataQuality"
    cost_namespace: str = "ClaimsDQ/Cost"

    # Metric dimensions: the folder whose roll-up the alarms watch.
    folder: str = "claims/"

    # Broadcast guard: a small side is broadcast only when both its checked row
    # count and its checked size are within these; beyond it the join shuffles
    # (AQE splits skew).
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 << 20

    def at(self, run_ts: dt.datetime) -> "DQParams":
        """The same parameters with every unset clock value taken from ``run_ts``
        (an aware datetime)."""
        utc = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return replace(self, as_of=self.as_of or utc.date(), as_of_ts=self.as_of_ts or utc,
                       cost_as_of=self.cost_as_of or utc.date())

    def need(self, name: str):
        """A clock value; an error where the caller has set none."""
        value = getattr(self, name)
        if value is None:
            raise ValueError(f"parameter {name} is not set")
        return value

    def with_(self, **kw) -> "DQParams":
        return replace(self, **kw)


DEFAULT = DQParams()
