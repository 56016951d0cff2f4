"""Table schemas. Inputs are always read with these, never inferred."""

from pyspark.sql import types as T

RISK_ENTRY = T.StructType([
    T.StructField("score", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("previous_score", T.IntegerType()),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("contact", T.StructType([
        T.StructField("phone", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
    ])),
    T.StructField("medical_history", T.StructType([
        T.StructField("conditions", T.ArrayType(T.StringType())),
        T.StructField("allergies", T.ArrayType(T.StringType())),
        T.StructField("blood_type", T.StringType()),
    ])),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("admission_date", T.TimestampNTZType()),
    T.StructField("notes", T.StringType()),
    T.StructField("risk_score_updated", T.TimestampNTZType()),
    T.StructField("risk_score_history", T.ArrayType(RISK_ENTRY)),
])

READING_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("heart_rate", T.IntegerType()),
    T.StructField("blood_pressure", T.StructType([
        T.StructField("systolic", T.IntegerType()),
        T.StructField("diastolic", T.IntegerType()),
    ])),
    T.StructField("oxygen_saturation", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

LANDED_READING_SCHEMA = T.StructType([
    *READING_SCHEMA.fields,
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
])

# One row per score change; the whole history of a patient is the set of its rows.
RISK_HISTORY_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("previous_score", T.IntegerType()),
    T.StructField("score", T.IntegerType()),
])

RISK_UPDATE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

PATCH_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])
