import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsegrid.schemas import PROFILE_SCHEMA, READING_SCHEMA  # noqa: E402
from pulsegrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def profile(patient_id, age=40, gender="F", city="Oslen", conditions=(), risk=5, admitted=None, blood="A+", **more):
    contact = more.pop("contact", {"phone": "05", "email": None, "city": city})
    history = more.pop("history", {
        "conditions": None if conditions is None else list(conditions), "allergies": [], "blood_type": blood})
    row = {"patient_id": patient_id, "name": f"name {patient_id}", "age": age, "gender": gender, "contact": contact,
           "medical_history": history, "risk_score": risk, "admission_date": admitted, "notes": None,
           "risk_score_updated": None, "risk_score_history": None}
    return {**row, **more}


@pytest.fixture
def profiles_of(spark):
    return lambda *rows: spark.createDataFrame(list(rows), PROFILE_SCHEMA)


def reading(patient_id, ts, heart_rate=70, status="NORMAL", systolic=100, diastolic=70):
    return {"patient_id": patient_id, "timestamp": ts, "heart_rate": heart_rate,
            "blood_pressure": {"systolic": systolic, "diastolic": diastolic},
            "oxygen_saturation": 97, "temperature": 36.6, "status": status}


@pytest.fixture
def readings_of(spark):
    return lambda *rows: spark.createDataFrame(list(rows), READING_SCHEMA)


def tuples(df):
    return [tuple(r) for r in df.collect()]
