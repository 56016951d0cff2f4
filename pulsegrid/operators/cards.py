"""Patient cards, and risk history as a table beside the profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profiles import lookup
from .skew import top_n_per_key


def split_history(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profiles without the embedded history, one history row per embedded entry).

    The entries' places become ``seq``, counted up to -1 so that they sort before later updates.
    """
    entries = profiles.select(
        "patient_id",
        F.size("risk_score_history").alias("n"),
        F.posexplode("risk_score_history").alias("pos", "entry"),
    )
    history = entries.select(
        "patient_id",
        (F.col("pos") - F.col("n")).cast("long").alias("seq"),
        "entry.timestamp",
        "entry.previous_score",
        "entry.score",
    )
    return profiles.drop("risk_score_history"), history


def recent_history(history: DataFrame, last: int) -> DataFrame:
    """Per patient, the newest ``last`` entries as an array, oldest first."""
    newest = top_n_per_key(
        history.select("patient_id", "seq", "timestamp", "previous_score", "score"),
        ["patient_id"],
        [F.col("timestamp").desc_nulls_last(), F.col("seq").desc_nulls_last()],
        last,
    )
    entry = F.struct(F.col("rn"), F.struct("score", "timestamp", "previous_score").alias("entry"))
    return newest.groupBy("patient_id").agg(
        F.transform(F.sort_array(F.collect_list(entry), asc=False), lambda e: e["entry"]).alias("risk_score_history")
    )


def with_recent_history(profiles: DataFrame, history: DataFrame, last: int = 3) -> DataFrame:
    """Profiles with their newest ``last`` history entries embedded; the table keeps the rest."""
    return profiles.drop("risk_score_history").join(recent_history(history, last), "patient_id", "left")


def _joined(col: str) -> Column:
    return F.when(F.size(col) > 0, F.array_join(col, ", ")).otherwise("None")


def patient_card(
    profiles: DataFrame,
    ids=None,
    history: DataFrame | None = None,
    last: int = 3,
) -> DataFrame:
    """One flat row per patient: of the ids given (see ``lookup``) or of all patients.

    ``recent_changes`` lists the last risk changes, from the history table if given,
    else from the history embedded in the profile; it is null without any.
    """
    cards = profiles if ids is None else lookup(profiles, ids)
    if history is not None:
        cards = with_recent_history(cards, history, last)
    if "risk_score_history" in cards.columns:
        entries = F.col("risk_score_history")
        start = F.greatest(F.size(entries) - last + 1, F.lit(1))
        lines = F.transform(
            F.slice(entries, start, last),
            lambda e: F.format_string(
                "%s: %s → %s",
                F.date_format(e["timestamp"], "yyyy-MM-dd'T'HH:mm:ss"),
                e["previous_score"].cast("string"),
                e["score"].cast("string"),
            ),
        )
        changes = F.when(F.size(entries) > 0, F.array_join(lines, "; "))
    else:
        changes = F.lit(None).cast("string")
    return cards.select(
        "patient_id",
        "name",
        "age",
        "gender",
        "contact.phone",
        "contact.city",
        "risk_score",
        _joined("medical_history.conditions").alias("conditions"),
        _joined("medical_history.allergies").alias("allergies"),
        "medical_history.blood_type",
        F.coalesce("notes", F.lit("N/A")).alias("notes"),
        changes.alias("recent_changes"),
    )
