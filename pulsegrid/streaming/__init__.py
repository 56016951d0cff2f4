from .feeds import (  # noqa: F401
    stream_alerts,
    stream_cycle_counts,
    stream_dedup,
    stream_latest,
    stream_latest_n,
)
from .ingest import compact_ingested, read_ingested, read_rejected, start_ingest  # noqa: F401
from .live import (  # noqa: F401
    read_abnormal_patients,
    read_alerts,
    read_patients_monitored,
    read_running_totals,
    start_abnormal_patients,
    start_alerts,
    start_patients_monitored,
    start_running_totals,
)
from .risk import read_live_overview, read_live_profiles, read_risk_history, start_risk_updates  # noqa: F401
from .sinks import (  # noqa: F401
    append_stream,
    batch_durations,
    latest_changes,
    start_latest_n,
    write_changes,
)
