"""Bulk profile patches and risk-score updates, each with an audit row per request.

Requests of one patient apply in order, so each one's previous value is that of the
request before it, or the stored one for the first. Requests are cut into ranges of
equal size, and so are patients with many of them (see ``skew``): previous values are
found within a part, and the value carried into each part comes from the small table of
the cut patients' last values per part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import risk_band
from ..params import DEFAULTS, Params
from .cards import split_history
from .skew import SMALL_BYTES, last_per_field, top_n_per_key, value_before_row, values_before_parts, with_parts

NOT_IN_PROFILE = ("patient_id", "risk_score_history")


@dataclass(frozen=True)
class Updated:
    """New profiles, one audit row per request, and (risk updates) all history rows."""

    profiles: DataFrame
    audit: DataFrame
    history: DataFrame | None = None


def apply_risk_updates(
    profiles: DataFrame,
    updates: DataFrame,
    skip_unchanged: bool = False,
    params: Params = DEFAULTS,
    parts: int | None = None,
    parts_path: str | None = None,
) -> Updated:
    """Set risk scores from ``updates (patient_id, score, ts, seq)`` in (ts, seq) order, equal ones by score.

    Audit status is ``updated``, ``unchanged`` (equal score under ``skip_unchanged``: no
    history row), ``not_found`` or ``invalid`` (null score). A missing stored score is 0.
    The updates are written in ``parts`` ranges to ``parts_path`` at once, unless they are few (see ``with_parts``).
    History is a table: rows embedded in the given profiles are moved to it.
    """
    order = ["ts", "seq", "score"]
    asked = updates.select("patient_id", "score", "ts", "seq")
    write = F.when(F.col("score").isNotNull(), F.struct("score"))
    parted = with_parts(asked, "patient_id", order, parts, parts_path, SMALL_BYTES)
    stored = profiles.select("patient_id", F.struct(F.coalesce("risk_score", F.lit(0)).alias("score")).alias("start"))
    starts = values_before_parts(parted, stored, "patient_id", F.lit("start"), write, order)
    rows = value_before_row(parted, ["patient_id"], order, write, "in_part").join(starts, ["patient_id", "part"], "left")
    found = F.col("start").isNotNull()
    delta = F.col("score") - F.col("previous_score")
    audit = rows.withColumn("previous_score", F.when(found, F.coalesce("in_part", "start")["score"])).select(
        "patient_id",
        "seq",
        "ts",
        "previous_score",
        "score",
        delta.alias("delta"),
        F.when(delta > 0, "INCREASED").when(delta < 0, "DECREASED").when(delta == 0, "No change").alias("direction"),
        risk_band(F.col("previous_score"), params).alias("old_level"),
        risk_band(F.col("score"), params).alias("new_level"),
        F.when(~found, "not_found")
        .when(F.col("score").isNull(), "invalid")
        .when(F.lit(skip_unchanged) & (delta == 0), "unchanged")
        .otherwise("updated")
        .alias("status"),
    )
    applied = audit.filter(F.col("status") == "updated")
    written = applied if skip_unchanged else parted.filter(F.col("score").isNotNull())
    newest = top_n_per_key(
        written.select("patient_id", *order), ["patient_id"], [F.col(c).desc() for c in order], 1
    ).select("patient_id", F.struct("score", "ts").alias("new"))
    embedded = None
    if "risk_score_history" in profiles.columns:
        profiles, embedded = split_history(profiles)
    has_stamp = "risk_score_updated" in profiles.columns
    old_stamp = F.col("risk_score_updated") if has_stamp else F.lit(None).cast("timestamp_ntz")
    new_profiles = (
        profiles.join(newest, "patient_id", "left")
        .withColumn("risk_score", F.coalesce("new.score", "risk_score"))
        .withColumn("risk_score_updated", F.coalesce("new.ts", old_stamp))
        .drop("new")
    )
    history = applied.select("patient_id", "seq", F.col("ts").alias("timestamp"), "previous_score", "score")
    if embedded is not None:
        history = embedded.unionByName(history)
    return Updated(new_profiles, audit, history)


def _leaf_paths(schema: T.StructType) -> dict[str, T.DataType]:
    """Dotted path and type of every patchable field."""
    leaves = {}
    for field in schema.fields:
        if field.name in NOT_IN_PROFILE:
            continue
        if isinstance(field.dataType, T.StructType):
            leaves.update({f"{field.name}.{f.name}": f.dataType for f in field.dataType.fields})
        else:
            leaves[field.name] = field.dataType
    return leaves


def _typed(text: Column, dtype: T.DataType) -> Column:
    """Text as a value of the field's type; null if it does not fit."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return F.from_json(text, dtype.simpleString())
    return text.try_cast(dtype)


def _text(value: Column, dtype: T.DataType) -> Column:
    """The one text form of a typed value, so that equal values have equal texts."""
    return F.to_json(value) if isinstance(dtype, (T.ArrayType, T.StructType)) else value.cast("string")


def _by_path(paths: dict[str, T.DataType], of_path) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for path, dtype in paths.items():
        out = out.when(F.col("path") == path, of_path(path, dtype))
    return out


def apply_profile_patches(
    profiles: DataFrame,
    patches: DataFrame,
    parts: int | None = None,
    parts_path: str | None = None,
) -> Updated:
    """Set profile fields from ``patches (patient_id, path, value, seq)`` in seq order, equal ones by value.

    ``path`` is dotted, ``value`` text that is cast to the field's type (JSON for
    arrays). Audit status is ``updated``, ``unchanged`` (equal to the value before it;
    a missing field reads as null), ``not_found`` (no such patient) or ``invalid`` (no
    such field, or text that does not fit it). Replaying patches changes nothing. The
    patches are written in ``parts`` ranges to ``parts_path`` at once, unless they are few (see ``with_parts``).
    """
    paths = _leaf_paths(profiles.schema)
    new = _by_path(paths, lambda path, dtype: _text(_typed(F.col("value"), dtype), dtype))
    valid = F.col("path").isin(*paths) & (F.col("value").isNull() | F.col("new").isNotNull())
    typed = patches.select("patient_id", "path", "seq", "value", new.alias("new")).select(
        "patient_id",
        "path",
        "seq",
        F.replace("path", F.lit("."), F.lit("__")).alias("field"),
        F.coalesce("new", "value").alias("asked"),
        F.when(valid, F.struct("new")).alias("write"),
    )
    order = ["seq", "asked"]
    parted = with_parts(typed, "patient_id", [*order, "path"], parts, parts_path, SMALL_BYTES)
    stored = profiles.select(
        "patient_id", *[F.struct(_text(F.col(p), t).alias("new")).alias(_flat(p)) for p, t in paths.items()]
    )
    starts = values_before_parts(parted, stored, "patient_id", F.col("field"), F.col("write"), order)
    # The window's rows are laid out for the join, so that they are shuffled once.
    laid_out = parted.repartition("patient_id", "part")
    rows = value_before_row(laid_out, ["patient_id", "path"], order, F.col("write"), "in_part").join(
        starts.withColumn("found", F.lit(True)), ["patient_id", "part"], "left"
    )
    start = _by_path(paths, lambda path, dtype: F.col(_flat(path))["new"])
    old = F.when(F.col("in_part").isNotNull(), F.col("in_part.new")).otherwise(start)
    found = F.col("found").isNotNull()
    audit = rows.withColumn("old", F.when(found, old)).select(
        "patient_id",
        "path",
        "seq",
        "old",
        F.col("asked").alias("new"),
        F.when(~found, "not_found")
        .when(F.col("write").isNull(), "invalid")
        .when(F.col("old").eqNullSafe(F.col("asked")), "unchanged")
        .otherwise("updated")
        .alias("status"),
    )
    return Updated(_patched(profiles, parted, paths), audit)


def _flat(path: str) -> str:
    return path.replace(".", "__")


def _patched(profiles: DataFrame, typed: DataFrame, paths: dict[str, T.DataType]) -> DataFrame:
    names = [_flat(p) for p in paths]
    last = last_per_field(typed, ["patient_id"], F.col("field"), F.col("write"), ["seq", "asked"], names)
    joined = profiles.join(last.select("patient_id", F.struct(*names).alias("w")), "patient_id", "left")

    def asked(path):
        return F.col("w." + _flat(path))

    def patched(path, dtype):
        return F.when(asked(path).isNotNull(), _typed(asked(path)["new"], dtype)).otherwise(F.col(path))

    columns = []
    for field in profiles.schema.fields:
        inner = [f"{field.name}.{f.name}" for f in field.dataType.fields] if isinstance(field.dataType, T.StructType) else []
        if inner:
            kept = F.col(field.name).isNotNull()
            for path in inner:
                kept = kept | asked(path).isNotNull()
            parts = [patched(p, paths[p]).alias(p.split(".")[1]) for p in inner]
            columns.append(F.when(kept, F.struct(*parts)).alias(field.name))
        elif field.name in paths:
            columns.append(patched(field.name, paths[field.name]).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return joined.select(*columns)
