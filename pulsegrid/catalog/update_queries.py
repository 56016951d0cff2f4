from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cards import patient_card
from ..operators.updates import apply_profile_patches, apply_risk_updates
from ..sources.star import star_patches, star_risk_updates
from .reading_queries import REFILED, refiled_profiles
from .registry import CONDITIONS_TEXT, PROFILES, RISK_LEVEL, query

UPDATES = f"""WITH {PROFILES},
known AS {REFILED},
updates AS (
  SELECT user_id AS patient_id, 1 + CAST(floor(value) AS INTEGER) % 10 AS score, ts, event_id AS seq FROM events
),
chained AS (
  SELECT u.*, k.patient_id IS NOT NULL AS found,
         CASE WHEN k.patient_id IS NOT NULL THEN coalesce(lag(score) OVER w, risk_score, 0) END AS previous_score
  FROM updates u LEFT JOIN known k ON k.patient_id = u.patient_id
  WINDOW w AS (PARTITION BY u.patient_id ORDER BY ts, seq)
)"""


def _audit(unchanged: str = "'updated'") -> str:
    return UPDATES + f"""
SELECT patient_id, seq, ts, previous_score, score, score - previous_score AS delta,
       CASE WHEN score > previous_score THEN 'INCREASED' WHEN score < previous_score THEN 'DECREASED'
            WHEN score = previous_score THEN 'No change' END AS direction,
       {RISK_LEVEL.format('previous_score')} AS old_level, {RISK_LEVEL.format('score')} AS new_level,
       CASE WHEN NOT found THEN 'not_found' WHEN score = previous_score THEN {unchanged} ELSE 'updated' END AS status
FROM chained"""


def _risk(spark, sf, **options):
    return apply_risk_updates(refiled_profiles(spark, sf), star_risk_updates(spark, sf), **options)


@query("risk_change", _audit())
def _(spark, sf):
    return _risk(spark, sf).audit


@query("risk_change_skip_unchanged", _audit("'unchanged'"))
def _(spark, sf):
    return _risk(spark, sf, skip_unchanged=True).audit


@query("risk_change_split_keys", _audit())
def _(spark, sf):
    """So many ranges that patients with few updates are cut into parts too."""
    return _risk(spark, sf, parts=64).audit


@query("risk_history", UPDATES + """
SELECT patient_id, seq, ts AS "timestamp", previous_score, score FROM chained WHERE found""")
def _(spark, sf):
    return _risk(spark, sf).history


def new_profiles_sql(only: str) -> str:
    return UPDATES + f"""
SELECT k.patient_id, coalesce(n.score, k.risk_score) AS risk_score, n.ts AS risk_score_updated
FROM known k LEFT JOIN (
  SELECT patient_id, score, ts FROM chained WHERE found AND {only}
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, seq DESC) = 1
) n ON n.patient_id = k.patient_id"""


@query("risk_profiles", new_profiles_sql("true"))
def _(spark, sf):
    return _risk(spark, sf).profiles.select("patient_id", "risk_score", "risk_score_updated")


@query("risk_profiles_skip_unchanged", new_profiles_sql("score <> previous_score"))
def _(spark, sf):
    return _risk(spark, sf, skip_unchanged=True).profiles.select("patient_id", "risk_score", "risk_score_updated")


@query("patient_card_history", UPDATES + f""",
lines AS (
  SELECT patient_id, ts, seq, strftime(ts, '%Y-%m-%dT%H:%M:%S') || ': ' || previous_score || ' → ' || score AS line
  FROM chained WHERE found QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, seq DESC) <= 3
),
latest AS (
  SELECT patient_id, score FROM chained WHERE found
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, seq DESC) = 1
)
SELECT k.patient_id, k.name, k.age, k.gender, k.phone, k.city, coalesce(l.score, k.risk_score) AS risk_score,
       {CONDITIONS_TEXT} AS conditions, 'None' AS allergies, k.blood_type, 'N/A' AS notes,
       (SELECT string_agg(line, '; ' ORDER BY ts, seq) FROM lines WHERE lines.patient_id = k.patient_id) AS recent_changes
FROM known k LEFT JOIN latest l ON l.patient_id = k.patient_id""")
def _(spark, sf):
    updated = _risk(spark, sf)
    return patient_card(updated.profiles, history=updated.history)


PATCHES = rf"""WITH {PROFILES},
known AS {REFILED},
raw AS (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events),
patches AS (
  SELECT user_id AS patient_id, event_id AS seq,
         CASE event_type WHEN 'view' THEN 'age' WHEN 'click' THEN 'contact.phone'
              WHEN 'signup' THEN 'medical_history.blood_type' WHEN 'purchase' THEN 'notes' ELSE 'contact.fax' END AS path,
         CASE WHEN event_type = 'view' AND k < 5 THEN 'old' WHEN event_type = 'purchase' AND k % 2 = 0 THEN NULL
              WHEN event_type = 'view' THEN CAST(20 + k // 25 AS VARCHAR) ELSE CAST(k % 4 AS VARCHAR) END AS value
  FROM raw
),
typed AS (
  SELECT *, path <> 'contact.fax' AND (path <> 'age' OR value IS NULL OR try_cast(value AS INTEGER) IS NOT NULL) AS valid
  FROM patches
),
chained AS (
  SELECT t.patient_id, t.path, t.seq, t.value AS new, t.valid, k.patient_id IS NOT NULL AS found,
         last_value(CASE WHEN valid THEN struct_pack(v := t.value) END IGNORE NULLS) OVER (
           PARTITION BY t.patient_id, t.path ORDER BY t.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
         CASE t.path WHEN 'age' THEN CAST(k.age AS VARCHAR) WHEN 'contact.phone' THEN k.phone
              WHEN 'medical_history.blood_type' THEN k.blood_type END AS stored
  FROM typed t LEFT JOIN known k ON k.patient_id = t.patient_id
),
audit AS (
  SELECT patient_id, path, seq, CASE WHEN NOT found THEN NULL WHEN before IS NULL THEN stored ELSE before.v END AS old,
         new, found, valid FROM chained
)"""


def _patches(spark, sf, **options):
    return apply_profile_patches(refiled_profiles(spark, sf), star_patches(spark, sf), **options)


PATCH_AUDIT = PATCHES + """
SELECT patient_id, path, seq, old, new,
       CASE WHEN NOT found THEN 'not_found' WHEN NOT valid THEN 'invalid'
            WHEN old IS NOT DISTINCT FROM new THEN 'unchanged' ELSE 'updated' END AS status
FROM audit"""


@query("profile_patch_audit", PATCH_AUDIT)
def _(spark, sf):
    return _patches(spark, sf).audit


@query("profile_patch_audit_split_keys", PATCH_AUDIT)
def _(spark, sf):
    return _patches(spark, sf, parts=64).audit


@query("patched_profiles", PATCHES + """,
newest AS (
  SELECT patient_id, path, new FROM audit WHERE found AND valid
  QUALIFY row_number() OVER (PARTITION BY patient_id, path ORDER BY seq DESC) = 1
),
wide AS (
  SELECT patient_id, bool_or(path = 'age') AS a, max(new) FILTER (path = 'age') AS age,
         bool_or(path = 'contact.phone') AS p, max(new) FILTER (path = 'contact.phone') AS phone,
         bool_or(path = 'medical_history.blood_type') AS b, max(new) FILTER (path = 'medical_history.blood_type') AS blood,
         max(new) FILTER (path = 'notes') AS notes
  FROM newest GROUP BY patient_id
)
SELECT k.patient_id, CASE WHEN a THEN CAST(w.age AS INTEGER) ELSE k.age END AS age,
       CASE WHEN p THEN w.phone ELSE k.phone END AS phone, k.city,
       CASE WHEN b THEN w.blood ELSE k.blood_type END AS blood_type, w.notes, k.risk_score
FROM known k LEFT JOIN wide w ON w.patient_id = k.patient_id""")
def _(spark, sf):
    return _patches(spark, sf).profiles.select(
        "patient_id", "age", F.col("contact.phone"), F.col("contact.city"), F.col("medical_history.blood_type"), "notes", "risk_score")
