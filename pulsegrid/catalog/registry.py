"""Query registry and the SQL pieces that several oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def ratio(part: str, whole: str, digits: int) -> str:
    """``part / whole`` of non-negative integers, rounded half up in integer arithmetic."""
    scale = 10**digits
    return f"(({2 * scale} * ({part}) + ({whole})) // (2 * ({whole})))::DOUBLE / {scale}"


def share(part: str, whole: str) -> str:
    return ratio(f"100 * {part}", whole, 1)


PROFILES = """
profiles AS (
  SELECT c_custkey AS patient_id, c_name AS name, CAST(20 + c_custkey % 66 AS INTEGER) AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         '0' || c_custkey AS phone, n_name AS city, c_mktsegment AS blood_type, o.conditions,
         CAST(floor((c_acctbal + 1000) / 1100) AS INTEGER) + 1 AS risk_score, o.admission_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (
    SELECT o_custkey, max(o_orderdate) AS admission_date,
           coalesce(list_sort(list(DISTINCT o_orderpriority) FILTER (o_totalprice > 430000)), []) AS conditions
    FROM orders GROUP BY o_custkey
  ) o ON o_custkey = c_custkey
)"""

READINGS = r"""
readings AS (
  SELECT user_id AS patient_id, event_id, ts AS "timestamp", value AS heart_rate,
         CAST(70 + k AS INTEGER) AS bp_systolic, CAST(40 + k * 7 // 10 AS INTEGER) AS bp_diastolic,
         CASE WHEN event_type = 'error' THEN 'ABNORMAL' ELSE 'NORMAL' END AS status
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events)
)"""

AGE_BAND = "CASE WHEN age < 30 THEN '18-29' WHEN age < 50 THEN '30-49' WHEN age < 65 THEN '50-64' ELSE '65+' END"
RISK_LEVEL = "CASE WHEN {0} >= 7 THEN 'HIGH' WHEN {0} >= 4 THEN 'MEDIUM' WHEN {0} < 4 THEN 'LOW' END"
CONDITIONS_TEXT = "CASE WHEN len(conditions) > 0 THEN array_to_string(conditions, ', ') ELSE 'None' END"


def with_profiles(body: str) -> str:
    return f"WITH {PROFILES}\n{body}"


def with_readings(body: str) -> str:
    return f"WITH {READINGS}\n{body}"


def with_both(body: str) -> str:
    return f"WITH {PROFILES},{READINGS}\n{body}"
