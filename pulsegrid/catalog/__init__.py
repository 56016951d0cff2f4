"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from . import profile_queries, reading_queries, source_queries, stream_queries, update_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
