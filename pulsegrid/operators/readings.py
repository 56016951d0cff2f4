"""Analyses over monitoring readings: latest-n, abnormal detection, counters, dedup.

Readings have ``patient_id, timestamp, heart_rate, blood_pressure, status``;
``event_id``, if present, breaks ties in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import heart_rate_severity
from ..functions.keys import epoch, newest_first, reading_key
from ..functions.numbers import percent
from ..params import VITAL_RANGES
from .skew import SLICES, top_n_per_key

IS_ABNORMAL = "status = 'ABNORMAL'"


def abnormal_only(readings: DataFrame) -> DataFrame:
    return readings.filter(IS_ABNORMAL)


def within_minutes(readings: DataFrame, minutes: int, as_of=None) -> DataFrame:
    """Readings of the last ``minutes`` before ``as_of`` (default: now).

    On a table with an ``event_date`` only the dates of that time are read, and two days before:
    whatever zones writer and reader have, their dates of one instant differ by less.
    """
    moment = F.localtimestamp() if as_of is None else F.lit(as_of)
    since = moment - F.make_dt_interval(mins=F.lit(minutes))
    if "event_date" in readings.columns:
        readings = readings.filter(F.col("event_date") >= F.date_sub(F.to_date(since), 2))
    return readings.filter(F.col("timestamp") >= since)


def _pressure(name: str) -> Column:
    return F.col(f"blood_pressure.{name}")


def flatten_readings(readings: DataFrame) -> DataFrame:
    """Blood pressure as the two columns ``bp_systolic`` and ``bp_diastolic``."""
    return readings.select(
        *[c for c in readings.columns if c != "blood_pressure"],
        _pressure("systolic").alias("bp_systolic"),
        _pressure("diastolic").alias("bp_diastolic"),
    )


def dedup_readings(readings: DataFrame, unit: str = "second", keep: str = "last") -> DataFrame:
    """One reading per key ``<patient_id>_<epoch unit>``, added as ``key``.

    The last write wins (``keep='first'`` keeps the first), by ``ingested_at`` if the
    table has it, then by ``event_id``, or by time without one, then by a hash of the row. Copies are cut to one
    per map task before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    patient, ts = F.col("patient_id"), F.col("timestamp")
    written = [F.col("ingested_at")] if "ingested_at" in readings.columns else []
    if "event_id" in readings.columns:
        written.append(F.col("event_id"))
    else:
        written.append(F.col("timestamp"))
    written.append(F.xxhash64(*readings.columns))
    order = [c.desc_nulls_last() if keep == "last" else c.asc_nulls_first() for c in written]
    # The number first: it tells most rows apart when they are sorted.
    one = top_n_per_key(readings.withColumn("_epoch", epoch(ts, unit)), ["_epoch", "patient_id"], order, 1)
    return one.drop("rn", "_epoch").withColumn("key", reading_key(patient, ts, unit))


def latest_readings(readings: DataFrame, n: int = 20, patient_id=None) -> DataFrame:
    """The newest n readings of every patient (or of one), numbered ``rn`` from 1."""
    if patient_id is not None:
        readings = readings.filter(F.col("patient_id") == patient_id)
    return top_n_per_key(readings, ["patient_id"], newest_first(readings), n)


def patients_monitored(readings: DataFrame, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return readings.agg(count("patient_id").alias("patients"))


def enrich(readings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Name, age and conditions of the patient beside each reading; batch or streaming.

    An unknown patient has name ``Unknown``, a null age and no conditions. The profile
    side has one row per patient, so adaptive execution can split a hot patient's readings.
    """
    known = profiles.select(
        "patient_id",
        F.lit(True).alias("known"),
        "name",
        "age",
        F.col("medical_history.conditions").alias("conditions"),
    )
    joined = readings.join(known, "patient_id", "left")
    unknown = F.col("known").isNull()
    return (
        joined.withColumn("name", F.when(unknown, "Unknown").otherwise(F.col("name")))
        .withColumn("conditions", F.coalesce("conditions", F.array().cast("array<string>")))
        .drop("known")
    )


#: What the detection of abnormal patients reads of a reading.
NEWEST_COLUMNS = ("patient_id", "event_id", "timestamp", "heart_rate", "blood_pressure", "temperature", "status")


def newest_abnormal(
    readings: DataFrame, n: int = 5, window_minutes: int | None = None, as_of=None
) -> DataFrame:
    """Per patient the newest ABNORMAL reading among the newest n: at most one row each.

    ``window_minutes`` also asks that it is not older than that; as time order decides
    the newest n, it may be applied at the scan.
    """
    if window_minutes is not None:
        readings = within_minutes(readings, window_minutes, as_of)
    newest = latest_readings(readings.select(*[c for c in NEWEST_COLUMNS if c in readings.columns]), n)
    first = top_n_per_key(abnormal_only(newest), ["patient_id"], [F.col("rn")], 1, rank="first")
    temperature = F.col("temperature") if "temperature" in readings.columns else F.lit(None).cast("double")
    return first.select(
        "patient_id",
        "heart_rate",
        _pressure("systolic").alias("systolic"),
        _pressure("diastolic").alias("diastolic"),
        temperature.alias("temperature"),
        "timestamp",
    )


ABNORMAL_COLUMNS = (
    "patient_id", "name", "age", "conditions", "heart_rate", "systolic", "diastolic", "temperature", "timestamp",
)


def abnormal_patients(
    readings: DataFrame,
    profiles: DataFrame,
    n: int = 5,
    window_minutes: int | None = None,
    as_of=None,
) -> DataFrame:
    """``newest_abnormal`` with the patients' profiles."""
    return enrich(newest_abnormal(readings, n, window_minutes, as_of), profiles).select(*ABNORMAL_COLUMNS)


def abnormal_summary(
    readings: DataFrame,
    profiles: DataFrame,
    k: int = 10,
    n: int = 5,
    window_minutes: int | None = None,
    as_of=None,
) -> DataFrame:
    """The first k abnormal patients by id, with how many were ``found`` and how many ``more`` there are.

    One pass over the readings: each slice of the patients gives its number and its own first k, and only these
    few rows meet in one task. Only the k shown are joined with their profiles.
    """
    sliced = Window.partitionBy(F.pmod(F.xxhash64("patient_id"), F.lit(SLICES)))
    everywhere = Window.partitionBy(F.lit(0))
    heads = (
        newest_abnormal(readings, n, window_minutes, as_of)
        .withColumns({"_n": F.count("*").over(sliced), "_rn": F.row_number().over(sliced.orderBy("patient_id"))})
        .filter(F.col("_rn") <= k)
    )
    shown = heads.withColumns({
        "found": F.sum(F.when(F.col("_rn") == 1, F.col("_n"))).over(everywhere),
        "_at": F.row_number().over(everywhere.orderBy("patient_id")),
    }).filter(F.col("_at") <= k)
    more = F.greatest(F.col("found") - k, F.lit(0)).alias("more")
    return enrich(shown, profiles).select(*ABNORMAL_COLUMNS, "found", more)


def alert_columns(readings: DataFrame, *extra: str) -> DataFrame:
    return readings.select(
        "patient_id",
        *extra,
        "heart_rate",
        _pressure("systolic").alias("bp_systolic"),
        _pressure("diastolic").alias("bp_diastolic"),
        "timestamp",
        heart_rate_severity(F.col("heart_rate")).alias("severity"),
    )


def alerts(readings: DataFrame, scan: int = 100, k: int = 15) -> DataFrame:
    """The newest k ABNORMAL readings among the newest ``scan`` readings, with severity."""
    used = ("patient_id", "event_id", "timestamp", "heart_rate", "blood_pressure", "status")
    readings = readings.select(*[c for c in used if c in readings.columns])
    newest = newest_first(readings)
    return alert_columns(abnormal_only(readings.orderBy(*newest).limit(scan)).orderBy(*newest).limit(k))


#: Stands for a missing time while windows are computed, as these drop rows without one.
NO_TIME = "1000-01-01"


def windowed(readings: DataFrame, width: str) -> DataFrame:
    """Batch readings with ``window_start``, the beginning of their tumbling window; null without a time."""
    ts = readings.schema["timestamp"].dataType
    timed = readings.withColumn("_time", F.coalesce("timestamp", F.lit(NO_TIME).cast(ts)))
    start = F.when(F.col("timestamp").isNotNull(), F.col("_window.start")).alias("window_start")
    return timed.withColumn("_window", F.window("_time", width)).select(*[F.col(c) for c in readings.columns if c != "window_start"], start)


def cycle_counts(readings: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Readings and ABNORMAL readings per tumbling window; batch or streaming.

    Readings without a time are counted in a row without ``window_start``; a stream has no such row, as its
    watermark needs a time.
    """
    if readings.isStreaming:
        rows, by = readings, F.window("timestamp", width).alias("w")
    else:
        rows, by = windowed(readings.select("timestamp", "status"), width), F.col("window_start")
    counted = rows.groupBy(by).agg(F.count("*").alias("events"), F.count_if(F.expr(IS_ABNORMAL)).alias("abnormal"))
    return counted.select(F.col("w.start").alias("window_start"), "events", "abnormal") if readings.isStreaming else counted


def day_totals(windows: DataFrame) -> DataFrame:
    """Windows ``(day, window_start, events, abnormal)`` with their totals since the day began."""
    so_far = Window.partitionBy("day").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return windows.withColumn("e_day", F.sum("events").over(so_far)).withColumn("a_day", F.sum("abnormal").over(so_far))


def over_days(windows: DataFrame) -> DataFrame:
    """Totals up to each window, and the abnormal share so far, of windows with the totals of their day."""
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        windows.groupBy("day")
        .agg(F.sum("events").alias("e"), F.sum("abnormal").alias("a"))
        .select(
            "day",
            F.coalesce(F.sum("e").over(before), F.lit(0)).alias("e_before"),
            F.coalesce(F.sum("a").over(before), F.lit(0)).alias("a_before"),
        )
    )
    return (
        windows
        .join(days.withColumnRenamed("day", "_day"), F.col("day").eqNullSafe(F.col("_day")), "left")  # an inner join would filter one side's scan: no shared shuffle
        .select(
            "window_start",
            "events",
            "abnormal",
            (F.col("e_before") + F.col("e_day")).alias("total"),
            (F.col("a_before") + F.col("a_day")).alias("total_abnormal"),
        )
        .withColumn("abnormal_pct", percent(F.col("total_abnormal"), F.col("total")))
    )


def running_totals(readings: DataFrame, width: str = "5 seconds") -> DataFrame:
    """``cycle_counts`` with totals up to each window and the abnormal share so far.

    Windows are summed within their day; only the day totals, one row a day, are
    summed in a single task. Readings without a time come first, as a window of their own.
    """
    return over_days(day_totals(cycle_counts(readings, width).withColumn("day", F.to_date("window_start"))))


def hourly_trend(readings: DataFrame) -> DataFrame:
    """NORMAL and ABNORMAL readings for each of the 24 hours of the day; readings without a time have no hour and are
    left out."""
    counted = readings.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.count_if(F.col("status") == "NORMAL").alias("normal"),
        F.count_if(F.expr(IS_ABNORMAL)).alias("abnormal"),
    )
    hours = readings.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(counted, "hour", "left").na.fill(0, ["normal", "abnormal"]).orderBy("hour")


def classify_vitals(
    readings: DataFrame,
    ranges: dict[str, tuple[int, int]] | None = None,
    min_out_of_range: int = 3,
) -> DataFrame:
    """Flag each vital outside its normal range and derive ``status`` from the flags.

    ``ABNORMAL`` needs ``min_out_of_range`` of the three vitals out of range. A missing
    vital is not out of range.
    """
    ranges = {**VITAL_RANGES, **(ranges or {})}
    vitals = {
        "hr_out": ("heart_rate", F.col("heart_rate")),
        "sys_out": ("systolic", _pressure("systolic")),
        "dia_out": ("diastolic", _pressure("diastolic")),
    }
    flags = {
        name: F.coalesce(~col.between(*ranges[vital]), F.lit(False)) for name, (vital, col) in vitals.items()
    }
    out = readings.withColumns(flags)
    count = sum((F.col(name).cast("int") for name in flags), F.lit(0))
    return out.withColumn("status", F.when(count >= min_out_of_range, "ABNORMAL").otherwise("NORMAL"))
