from .bands import age_band, band, gender_label, heart_rate_severity, risk_band  # noqa: F401
from .keys import key_patient_id, newest_first, reading_key  # noqa: F401
from .numbers import percent, rounded_mean  # noqa: F401
