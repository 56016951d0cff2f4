"""Reading keys ``<patient_id>_<epoch>`` and the newest-first order of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_UNITS = ("second", "millisecond", "minute", "hour")


def epoch(ts: Column, unit: str = "second") -> Column:
    """Whole units since 1970; a timestamp without zone is read in the session's zone."""
    if unit not in KEY_UNITS:
        raise ValueError(f"unit must be one of {KEY_UNITS}")
    instant = ts.cast("timestamp")
    if unit == "millisecond":
        return F.unix_millis(instant)
    seconds = F.unix_seconds(instant)
    width = {"second": 1, "minute": 60, "hour": 3600}[unit]
    return seconds if width == 1 else F.floor(seconds / width)


def reading_key(patient_id: Column, ts: Column, unit: str = "second") -> Column:
    return F.concat_ws("_", patient_id.cast("string"), epoch(ts, unit).cast("string"))


def key_patient_id(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1))


def newest_first(readings: DataFrame) -> list[Column]:
    """Latest time first. ``event_id`` breaks ties; without it, a hash of the whole row does."""
    last = F.col("event_id") if "event_id" in readings.columns else F.xxhash64(*readings.columns)
    return [F.col("timestamp").desc_nulls_last(), last.desc_nulls_last()]
