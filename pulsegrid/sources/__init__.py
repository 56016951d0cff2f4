from .files import (  # noqa: F401
    corrupt_lines,
    import_key_values,
    land_lines,
    land_parquet,
    landed_rejects,
    landed_rows,
    parse_counts,
    read_landed_readings,
    read_profiles,
    read_readings,
    read_result,
    rejected_key_values,
    stream_readings,
)
from .log import NumberedLog  # noqa: F401
from .sinks import (  # noqa: F401
    ResultSet,
    append_readings,
    current_version,
    export_profiles,
    follow_commits,
    publish_version,
    read_published,
    replace_profiles,
    write_result,
)
