from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import key_patient_id, reading_key
from ..operators import readings as ops
from ..sources.star import star_profiles, star_readings
from .registry import CONDITIONS_TEXT, query, share, with_both, with_readings

REFILED = "(SELECT * REPLACE (CASE WHEN risk_score < 4 THEN -patient_id ELSE patient_id END AS patient_id) FROM profiles)"
NEWEST = '"timestamp" DESC NULLS LAST, event_id DESC NULLS LAST'
FLAT = 'patient_id, event_id, "timestamp", heart_rate, bp_systolic, bp_diastolic, status'


def refiled_profiles(spark, sf):
    """All profiles, those at low risk under the negative of their id: these patients' readings and updates are of unknown ones."""
    refiled = F.when(F.col("risk_score") < 4, -F.col("patient_id")).otherwise(F.col("patient_id"))
    return star_profiles(spark, sf).withColumn("patient_id", refiled)


def conditions_text(df):
    text = F.when(F.size("conditions") > 0, F.array_join("conditions", ", ")).otherwise("None")
    return df.withColumn("conditions", text)


def last_reading(readings):
    """The data's own "now": the time of the newest reading."""
    return readings.select(F.max("timestamp")).scalar()


@query("abnormal_readings", with_readings(f"SELECT {FLAT} FROM readings WHERE status = 'ABNORMAL'"))
def _(spark, sf):
    return ops.flatten_readings(ops.abnormal_only(star_readings(spark, sf)))


@query("recent_readings", with_readings(f"""
SELECT {FLAT} FROM readings
WHERE "timestamp" >= (SELECT max("timestamp") FROM readings) - INTERVAL 1440 MINUTES"""))
def _(spark, sf):
    readings = star_readings(spark, sf)
    return ops.flatten_readings(ops.within_minutes(readings, 1440, last_reading(readings)))


@query("reading_keys", with_readings("""
SELECT event_id, patient_id || '_' || CAST(floor(epoch("timestamp")) AS BIGINT) AS key,
       patient_id || '_' || epoch_us("timestamp") // 1000 AS key_ms, CAST(patient_id AS VARCHAR) AS key_patient
FROM readings"""))
def _(spark, sf):
    patient, ts = F.col("patient_id"), F.col("timestamp")
    keyed = star_readings(spark, sf).select(
        "event_id", reading_key(patient, ts).alias("key"), reading_key(patient, ts, "millisecond").alias("key_ms")
    )
    return keyed.withColumn("key_patient", key_patient_id(F.col("key")))


def dedup_sql(key: str) -> str:
    return with_readings(f"""
SELECT {FLAT}, key FROM (
  SELECT *, {key} AS key, row_number() OVER (PARTITION BY {key} ORDER BY event_id DESC) AS r FROM readings
) WHERE r = 1""")


@query("dedup_readings", dedup_sql("patient_id || '_' || CAST(floor(epoch(\"timestamp\")) AS BIGINT)"))
def _(spark, sf):
    return ops.flatten_readings(ops.dedup_readings(star_readings(spark, sf)))


@query("dedup_hourly", dedup_sql("patient_id || '_' || CAST(floor(epoch(\"timestamp\") / 3600) AS BIGINT)"))
def _(spark, sf):
    return ops.flatten_readings(ops.dedup_readings(star_readings(spark, sf), "hour"))


def latest_sql(n: int) -> str:
    return with_readings(f"""
SELECT {FLAT}, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY {NEWEST}) AS rn FROM readings
) WHERE rn <= {n}""")


@query("latest_readings", latest_sql(20))
def _(spark, sf):
    return ops.flatten_readings(ops.latest_readings(star_readings(spark, sf), 20))


@query("latest_reading", latest_sql(1))
def _(spark, sf):
    return ops.flatten_readings(ops.latest_readings(star_readings(spark, sf), 1))


@query("patient_latest_readings", with_readings(f"""
SELECT {FLAT}, CAST(row_number() OVER (ORDER BY {NEWEST}) AS INTEGER) AS rn FROM readings
WHERE patient_id = (SELECT min(patient_id) FROM readings) ORDER BY {NEWEST} LIMIT 20"""))
def _(spark, sf):
    """The newest readings of one patient."""
    readings = star_readings(spark, sf)
    return ops.flatten_readings(ops.latest_readings(readings, 20, readings.select(F.min("patient_id")).scalar()))


@query("cycle_counts_timeless", with_readings("").rstrip() + """
SELECT CASE WHEN event_id % 50 <> 0 THEN time_bucket(INTERVAL 1 HOUR, "timestamp") END AS window_start,
       count(*) AS events, count(*) FILTER (status = 'ABNORMAL') AS abnormal FROM readings GROUP BY 1""")
def _(spark, sf):
    """Hourly counters over readings of which every fiftieth has lost its time."""
    readings = star_readings(spark, sf)
    return ops.cycle_counts(readings.withColumn("timestamp", F.when(F.col("event_id") % 50 != 0, F.col("timestamp"))), "1 hour")


@query("latest_readings_50", latest_sql(50))
def _(spark, sf):
    return ops.flatten_readings(ops.latest_readings(star_readings(spark, sf), 50))


def abnormal_sql(source: str = "readings") -> str:
    return f"""
found AS (
  SELECT a.patient_id, coalesce(p.name, 'Unknown') AS name, p.age, {CONDITIONS_TEXT} AS conditions,
         heart_rate, bp_systolic AS systolic, bp_diastolic AS diastolic, NULL::DOUBLE AS temperature, "timestamp"
  FROM (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY {NEWEST}) AS rn FROM {source}
    ) WHERE rn <= 5 AND status = 'ABNORMAL'
    QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY rn) = 1
  ) a LEFT JOIN {REFILED} p USING (patient_id)
)"""


@query("abnormal_patients", with_both("").rstrip() + "," + abnormal_sql() + " SELECT * FROM found")
def _(spark, sf):
    return conditions_text(ops.abnormal_patients(star_readings(spark, sf), refiled_profiles(spark, sf)))


@query("abnormal_patients_last_day", with_both("").rstrip() + "," + abnormal_sql(
    '(SELECT * FROM readings WHERE "timestamp" >= (SELECT max("timestamp") FROM readings) - INTERVAL 1440 MINUTES)')
    + " SELECT * FROM found")
def _(spark, sf):
    readings = star_readings(spark, sf)
    return conditions_text(ops.abnormal_patients(
        readings, refiled_profiles(spark, sf), window_minutes=1440, as_of=last_reading(readings)))


@query("abnormal_summary", with_both("").rstrip() + "," + abnormal_sql() + """
SELECT patient_id, name, age, conditions, heart_rate, systolic, diastolic, temperature, "timestamp",
       (SELECT count(*) FROM found) AS found, greatest((SELECT count(*) FROM found) - 10, 0) AS more
FROM found ORDER BY patient_id LIMIT 10""")
def _(spark, sf):
    return conditions_text(ops.abnormal_summary(star_readings(spark, sf), refiled_profiles(spark, sf)))


@query("alerts", with_readings(f"""
SELECT patient_id, heart_rate, bp_systolic, bp_diastolic, "timestamp",
       CASE WHEN heart_rate > 120 THEN 'High' ELSE 'Medium' END AS severity
FROM (SELECT * FROM readings ORDER BY {NEWEST} LIMIT 100) WHERE status = 'ABNORMAL' ORDER BY {NEWEST} LIMIT 15"""))
def _(spark, sf):
    return ops.alerts(star_readings(spark, sf))


@query("enriched_readings", with_both(f"""
SELECT patient_id, event_id, coalesce(p.name, 'Unknown') AS name, p.age
FROM readings LEFT JOIN {REFILED} p USING (patient_id)"""))
def _(spark, sf):
    return ops.enrich(star_readings(spark, sf), refiled_profiles(spark, sf)).select("patient_id", "event_id", "name", "age")


@query("patients_monitored", with_readings("SELECT count(DISTINCT patient_id) AS patients FROM readings"))
def _(spark, sf):
    return ops.patients_monitored(star_readings(spark, sf))


def cycles_sql(width: str) -> str:
    return f"""
cycles AS (
  SELECT time_bucket(INTERVAL '{width}', "timestamp") AS window_start, count(*) AS events,
         count(*) FILTER (status = 'ABNORMAL') AS abnormal
  FROM readings GROUP BY 1
)"""


@query("cycle_counts", with_readings("").rstrip() + "," + cycles_sql("5 seconds") + " SELECT * FROM cycles")
def _(spark, sf):
    return ops.cycle_counts(star_readings(spark, sf))


@query("hourly_counts", with_readings("").rstrip() + "," + cycles_sql("1 hour") + " SELECT * FROM cycles")
def _(spark, sf):
    return ops.cycle_counts(star_readings(spark, sf), "1 hour")


def running_sql(width: str) -> str:
    return with_readings("").rstrip() + "," + cycles_sql(width) + f""",
sums AS (
  SELECT *, CAST(sum(events) OVER w AS BIGINT) AS total, CAST(sum(abnormal) OVER w AS BIGINT) AS total_abnormal
  FROM cycles WINDOW w AS (ORDER BY window_start)
)
SELECT *, {share('total_abnormal', 'total')} AS abnormal_pct FROM sums"""


@query("running_totals", running_sql("5 seconds"))
def _(spark, sf):
    return ops.running_totals(star_readings(spark, sf))


@query("running_totals_hourly", running_sql("1 hour"))
def _(spark, sf):
    return ops.running_totals(star_readings(spark, sf), "1 hour")


@query("hourly_trend", with_readings("""
SELECT CAST(h AS INTEGER) AS hour, count(*) FILTER (status = 'NORMAL') AS normal,
       count(*) FILTER (status = 'ABNORMAL') AS abnormal
FROM range(24) t(h) LEFT JOIN readings ON hour("timestamp") = h GROUP BY h"""))
def _(spark, sf):
    return ops.hourly_trend(star_readings(spark, sf))


def _vitals(need: int) -> str:
    return with_readings(f"""
SELECT event_id, hr_out, sys_out, dia_out,
       CASE WHEN hr_out::INT + sys_out::INT + dia_out::INT >= {need} THEN 'ABNORMAL' ELSE 'NORMAL' END AS status
FROM (SELECT event_id, heart_rate NOT BETWEEN 60 AND 100 AS hr_out, bp_systolic NOT BETWEEN 90 AND 120 AS sys_out,
             bp_diastolic NOT BETWEEN 60 AND 80 AS dia_out FROM readings)""")


@query("classify_vitals", _vitals(3))
def _(spark, sf):
    return ops.classify_vitals(star_readings(spark, sf)).select("event_id", "hr_out", "sys_out", "dia_out", "status")


@query("classify_vitals_any", _vitals(1))
def _(spark, sf):
    return ops.classify_vitals(star_readings(spark, sf), min_out_of_range=1).select(
        "event_id", "hr_out", "sys_out", "dia_out", "status")
