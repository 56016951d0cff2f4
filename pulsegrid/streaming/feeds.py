"""Streaming forms of the reading operators: streaming DataFrame in, streaming DataFrame out."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.keys import reading_key
from ..operators.readings import abnormal_only, alert_columns, cycle_counts, enrich
from ..sources.sinks import JSON_TIMES


def event_time(readings: DataFrame, lateness: str) -> DataFrame:
    """Watermark on ``timestamp``, which must carry a time zone for it."""
    return readings.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)


def stream_dedup(readings: DataFrame, lateness: str = "1 hour", unit: str = "second") -> DataFrame:
    """The first reading of every key ``<patient_id>_<epoch unit>``; state lives for ``lateness``.

    For the last write to win, land every reading (``start_ingest``) and read the table
    through ``dedup_readings``.
    """
    timed = event_time(readings, lateness)
    keyed = timed.withColumn("key", reading_key(F.col("patient_id"), F.col("timestamp"), unit))
    return keyed.dropDuplicatesWithinWatermark(["key"])


def stream_alerts(readings: DataFrame, profiles: DataFrame) -> DataFrame:
    """ABNORMAL readings with severity and the patient's name, age and conditions.

    The stored profiles are read again for every micro-batch. The query is stateless. A stream's plan sees the size of
    the files alone, which may be a small part of what the profiles take in memory, so it never sends them through the driver.
    """
    extra = [c for c in ("event_id",) if c in readings.columns]
    return enrich(alert_columns(abnormal_only(readings), *extra), profiles.hint("merge") if readings.isStreaming else profiles)


def stream_cycle_counts(readings: DataFrame, width: str = "5 seconds", lateness: str = "1 minute") -> DataFrame:
    """Readings and ABNORMAL readings per tumbling window.

    In update mode each changed window is emitted per micro-batch, in append mode each
    window once, after the watermark has passed its end.
    """
    return cycle_counts(event_time(readings, lateness), width)


def stream_latest(readings: DataFrame) -> DataFrame:
    """The newest reading of every patient (update or complete mode)."""
    ties = [c for c in ("event_id",) if c in readings.columns]
    fields = [c for c in readings.columns if c != "patient_id"]
    newest = F.max_by(F.struct(*fields), F.struct("timestamp", *(ties or [F.xxhash64(*readings.columns)])))
    return readings.groupBy("patient_id").agg(newest.alias("r")).select("patient_id", "r.*")


# Readings that a task holds at a time, some 100 MB, and their bytes at most, where they are long.
BUFFER_ROWS, BUFFER_BYTES = 1_000_000, 256 << 20
# A patient's newest readings in the state, a line each: its place in the order (time in microseconds and tie, as
# unsigned hexadecimal digits, so that lines sort by it), and all of its columns as JSON.
READINGS_STATE = T.StructType([T.StructField("readings", T.StringType())])
LAST, DIGITS = -(2**63), 16


def _digits(number: Column) -> Column:
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(LAST))), DIGITS, "0")


def _newest_of(parts: list[pa.RecordBatch], n: int) -> tuple[pa.Table, np.ndarray]:
    """The n largest lines of every patient in ``(patient_id, line)``, patient by patient, and where each patient's begin."""
    rows = pa.Table.from_batches(parts).sort_by([("patient_id", "ascending"), ("line", "descending")]).combine_chunks()
    patient = rows["patient_id"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
    starts = np.flatnonzero(np.diff(patient, prepend=-1))
    sizes = np.diff(starts, append=len(patient))
    kept = np.arange(len(patient)) - np.repeat(starts, sizes) < n
    return rows.filter(pa.array(kept)).combine_chunks(), np.cumsum(np.minimum(sizes, n)) - np.minimum(sizes, n)


def _row_a_patient(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    lines = rows["line"].combine_chunks()
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(rows)], pa.int32()), lines), "\n")
    return pa.RecordBatch.from_arrays([rows["patient_id"].combine_chunks().take(pa.array(starts)), texts], ["patient_id", "readings"])


def stream_latest_n(readings: DataFrame, n: int = 20, ttl_ms: int | None = None) -> DataFrame:
    """The newest n readings of every patient that changed, whole, numbered ``rn`` from 1 (update mode).

    Made for short micro-batches, whose patients are looked up in the RocksDB state
    store; ``start_latest_n`` is the form for large ones. Every task first drops what is not
    among a patient's newest n of up to BUFFER_ROWS rows, so a hot patient reaches its
    state as n readings per buffer. They go there, lie there and come back as one text, since a patient
    costs by the rows and calls between Spark and Python. Readings without a time come last, as in the batch form.
    """
    tie = F.col("event_id").cast("long") if "event_id" in readings.columns else F.xxhash64(*readings.columns)
    rows = readings.select(
        "patient_id",
        F.concat(
            _digits(F.coalesce(F.unix_micros(F.col("timestamp").cast("timestamp")), F.lit(LAST))),
            _digits(F.coalesce(tie, F.lit(LAST))),
            F.to_json(F.struct(*readings.columns), JSON_TIMES),
        ).alias("line"),
    )

    def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, size, used = [], 0, 0
        for batch in batches:
            buffer.append(batch)
            size, used = size + len(batch), used + batch.nbytes
            if size >= BUFFER_ROWS or used >= BUFFER_BYTES:
                kept, starts = _newest_of(buffer, n)
                buffer, size, used = kept.to_batches(), len(kept), kept.nbytes
                if size >= BUFFER_ROWS // 2 or used >= BUFFER_BYTES // 2:  # hardly fewer: pass them on
                    yield _row_a_patient(kept, starts)
                    buffer, size, used = [], 0, 0
        if size:
            yield _row_a_patient(*_newest_of(buffer, n))

    # Local, so that it is sent to the workers by value.
    class LatestN(StatefulProcessor):
        """Keeps a patient's newest n readings, and forgets a patient after ``ttl_ms`` without any."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.newest = handle.getValueState("newest", READINGS_STATE, ttl_ms)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            lines = [line for r in rows for line in r.readings.split("\n")]
            stored = self.newest.get()
            if stored is not None:
                lines += stored[0].split("\n")
            kept = "\n".join(nlargest(n, lines))
            self.newest.update((kept,))
            yield Row(patient_id=key[0], readings=kept)

        def close(self) -> None:
            pass

    out = T.StructType([readings.schema["patient_id"], *READINGS_STATE.fields])
    return (
        rows.mapInArrow(limit, out)
        .groupBy("patient_id")
        .transformWithState(LatestN(), out, "Update", "ProcessingTime" if ttl_ms else "None")
        .select(F.posexplode(F.split("readings", "\n")).alias("place", "line"))
        .select(F.from_json(F.col("line").substr(F.lit(2 * DIGITS + 1), F.length("line")), readings.schema).alias("r"), (F.col("place") + 1).alias("rn"))
        .select("r.*", "rn")
    )
