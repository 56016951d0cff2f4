from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import key_patient_id, reading_key
from ..operators.readings import dedup_readings, within_minutes
from ..plans.batch import save_batch
from ..session import scratch_path
from ..sources import files, sinks
from ..sources.star import star_profiles, star_readings
from .profile_queries import BATCH, PARAMS, last_admission, tidy_batch
from .registry import CONDITIONS_TEXT, query, with_profiles, with_readings

CARD = ["patient_id", "name", "age", "gender", "contact.phone", "contact.city", "medical_history.blood_type",
        "risk_score", "admission_date"]
PROFILE_ROWS = with_profiles(f"""
SELECT CAST(patient_id AS VARCHAR) AS patient_id, name, age, gender, phone, city, blood_type, risk_score,
       admission_date, {CONDITIONS_TEXT} AS conditions FROM profiles""")


def text_id():
    return F.col("patient_id").cast("string")


def _card(profiles):
    conditions = F.col("medical_history.conditions")
    text = F.when(F.size(conditions) > 0, F.array_join(conditions, ", ")).otherwise("None")
    return profiles.select(*CARD, text.alias("conditions"))


@query("profiles_json", PROFILE_ROWS)
def _(spark, sf):
    """Export to JSON Lines, without ``_id``, and read back with the explicit schema."""
    path = scratch_path(spark, "profiles-json")
    profiles = star_profiles(spark, sf).withColumn("patient_id", text_id())
    sinks.export_profiles(profiles.withColumn("_id", text_id()), path)
    return _card(files.read_profiles(spark, path))


def _broken_lines(spark, sf):
    """A file of profiles in which every tenth line has lost its end, landed by one parse."""
    path = scratch_path(spark, "profiles-broken")
    line = F.to_json(F.struct(text_id().alias("patient_id"), "name", "age"))
    broken = F.when(F.col("patient_id") % 10 == 0, F.left(line, F.length(line) - 1)).otherwise(line)
    star_profiles(spark, sf).select(broken.alias("value")).write.text(path)
    target = scratch_path(spark, "profiles-parsed")
    return target, files.land_lines(spark, path, target)


@query("profiles_rejects", with_profiles("SELECT CAST(patient_id AS VARCHAR) AS patient_id FROM profiles WHERE patient_id % 10 = 0"))
def _(spark, sf):
    """The lines that gave no profile."""
    target, _ = _broken_lines(spark, sf)
    return files.landed_rejects(spark, target).select(F.regexp_extract("line", r'"patient_id":"(\d+)"', 1).alias("patient_id"))


@query("profiles_parsed", with_profiles("""
SELECT CAST(patient_id AS VARCHAR) AS patient_id, name, age, (SELECT count(*) FROM profiles) AS lines,
       (SELECT count(*) FROM profiles WHERE patient_id % 10 = 0) AS rejects
FROM profiles WHERE patient_id % 10 <> 0"""))
def _(spark, sf):
    """The profiles beside them, and how many lines and rejects the parse counted."""
    target, seen = _broken_lines(spark, sf)
    rows = files.landed_rows(spark, target).select("patient_id", "name", "age")
    return rows.withColumns({name: F.lit(n).cast("long") for name, n in seen.items()})


@query("profiles_landed", PROFILE_ROWS)
def _(spark, sf):
    """JSON landed as Parquet, then replaced as a published version."""
    raw, root = scratch_path(spark, "profiles-raw"), scratch_path(spark, "profiles")
    sinks.export_profiles(star_profiles(spark, sf).withColumn("patient_id", text_id()), raw)
    sinks.publish_version(files.read_profiles(spark, raw), root)
    return _card(sinks.read_published(spark, root))


@query("profiles_replaced", PROFILE_ROWS)
def _(spark, sf):
    """A table loaded with wrong scores, then replaced as a whole."""
    path = scratch_path(spark, "profiles-replaced")
    profiles = star_profiles(spark, sf).withColumn("patient_id", text_id())
    sinks.replace_profiles(profiles.withColumn("risk_score", F.lit(0)), path)
    sinks.replace_profiles(profiles, path)
    return _card(sinks.read_published(spark, path))


@query("batch_saved", BATCH)
def _(spark, sf):
    """Every analysis written by the batch run and read back."""
    path = scratch_path(spark, "batch")
    profiles = star_profiles(spark, sf)
    saved = save_batch(profiles, path, last_admission(profiles), params=PARAMS)
    return tidy_batch({name: files.read_result(spark, path, name=name) for name in saved})


STAR_READING = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("heart_rate", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


@query("key_value_import", with_readings("""
SELECT CAST(patient_id AS VARCHAR) AS patient_id, event_id, "timestamp", heart_rate, status FROM readings"""))
def _(spark, sf):
    """Readings as a dump of keys and JSON values without patient ids, imported again."""
    readings = star_readings(spark, sf)
    value = F.to_json(F.struct("event_id", "timestamp", "heart_rate", "status"), sinks.JSON_TIMES)
    dump = readings.select(reading_key(F.col("patient_id"), F.col("timestamp")).alias("key"), value.alias("value"))
    return files.import_key_values(dump, STAR_READING).drop("key")


@query("key_value_rejects", with_readings("""
SELECT CAST(patient_id AS VARCHAR) AS patient_id, event_id FROM readings WHERE event_id % 10 = 0"""))
def _(spark, sf):
    """The entries of a dump, every tenth of them broken, that give no reading."""
    readings = star_readings(spark, sf)
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    value = F.when(F.col("event_id") % 10 == 0, broken).otherwise(F.to_json(F.struct("event_id", "heart_rate", "status")))
    dump = readings.select(reading_key(F.col("patient_id"), F.col("timestamp")).alias("key"), value.alias("value"))
    rejected = files.rejected_key_values(dump, STAR_READING)
    return rejected.select(
        key_patient_id(F.col("key")).alias("patient_id"), F.regexp_extract("value", r"(\d+)", 1).cast("long").alias("event_id"))


@query("recent_landed_readings", with_readings("""
SELECT patient_id, event_id, "timestamp", heart_rate, status FROM readings
WHERE "timestamp" >= (SELECT max("timestamp") FROM readings) - INTERVAL 1440 MINUTES"""))
def _(spark, sf):
    """The last day of readings landed by date under one time zone and read under another."""
    path, zone = scratch_path(spark, "landed"), spark.conf.get("spark.sql.session.timeZone")
    readings = star_readings(spark, sf).drop("blood_pressure")
    instants = readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        sinks.append_readings(instants, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    landed = spark.read.parquet(path)
    newest = readings.select(F.max("timestamp")).scalar().cast("timestamp")
    recent = within_minutes(landed, 1440, newest)
    return recent.select("patient_id", "event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "heart_rate", "status")


@query("append_last_wins", with_readings("""
SELECT patient_id, event_id, "timestamp", heart_rate + 1 AS heart_rate, status FROM readings
QUALIFY row_number() OVER (PARTITION BY patient_id, floor(epoch("timestamp")) ORDER BY event_id DESC) = 1"""))
def _(spark, sf):
    """The readings appended twice, the second time corrected: the last write of a key wins."""
    path = scratch_path(spark, "readings")
    readings = star_readings(spark, sf).drop("blood_pressure")
    sinks.append_readings(readings, path)
    sinks.append_readings(readings.withColumn("heart_rate", F.col("heart_rate") + 1), path)
    return dedup_readings(spark.read.parquet(path)).select("patient_id", "event_id", "timestamp", "heart_rate", "status")
