"""Options shared by the profile operators."""

from __future__ import annotations

from dataclasses import dataclass

# Bands, sentinels, thresholds and normal vital ranges that results depend on.
AGE_EDGES = (30, 50, 65)
AGE_LABELS = ("18-29", "30-49", "50-64", "65+")
RISK_EDGES = (4, 7)
RISK_LABELS = ("LOW", "MEDIUM", "HIGH")
HIGH_RISK_SCORE = 7
SENTINELS = ("None", "")
RECENT_ADMISSION_DAYS = 30
SEVERE_HEART_RATE = 120
VITAL_RANGES = {
    "heart_rate": (60, 100),
    "systolic": (90, 120),
    "diastolic": (60, 80),
}


@dataclass(frozen=True)
class Params:
    """Rules that differ between the batch analyses, the daily report and the dashboard.

    sentinels: condition texts that mean "no condition"; ``()`` keeps them.
    missing_label: label for a missing city or blood type; None keeps the null group.
    null_age_as_last: put a null age into the last band instead of the null band.
    null_risk_as_low: count a null risk score as low instead of in no band.
    """

    age_edges: tuple = AGE_EDGES
    age_labels: tuple = AGE_LABELS
    risk_edges: tuple = RISK_EDGES
    risk_labels: tuple = RISK_LABELS
    sentinels: tuple = SENTINELS
    missing_label: str | None = None
    null_age_as_last: bool = False
    null_risk_as_low: bool = False


DEFAULTS = Params()
