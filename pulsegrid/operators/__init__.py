from .cards import patient_card, split_history, with_recent_history  # noqa: F401
from .profiles import (  # noqa: F401
    admitted_within,
    age_stats,
    condition_counts,
    distribution,
    high_risk,
    lookup,
    mean_age,
    multi_condition,
    overview,
    patient_count,
    recent_patients,
    risk_by,
    risk_histogram,
    risk_shares,
    risk_summary,
    top_conditions,
)
from .readings import (  # noqa: F401
    abnormal_only,
    abnormal_patients,
    abnormal_summary,
    alerts,
    classify_vitals,
    cycle_counts,
    dedup_readings,
    enrich,
    flatten_readings,
    hourly_trend,
    latest_readings,
    newest_abnormal,
    patients_monitored,
    running_totals,
    within_minutes,
)
from .updates import apply_profile_patches, apply_risk_updates  # noqa: F401
