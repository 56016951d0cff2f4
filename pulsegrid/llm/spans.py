"""Places of regular-expression matches as columns, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,stop:int,value:string>"
SPANS = f"array<{SPAN}>"
CHUNK = 256


def match_spans(text: Column, pattern: Column) -> Column:
    """All leftmost, non-overlapping, non-empty matches in ``text``: (start, stop, value), in code points from 0.

    A match's start is the summed length of what ``split`` leaves before it and of the matches before it. Matches
    are gathered in chunks, so the work stays near the number of matches also in very long texts.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    state = F.struct(
        F.lit(0).alias("at"), found.alias("found"), F.split(text, pattern, -1).alias("gaps"),
        F.array().cast(f"array<{SPANS}>").alias("out"))

    def step(whole: Column):
        def place(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(whole["gaps"][i])
            value = whole["found"][i]
            span = F.struct(start.alias("start"), (start + F.length(value)).alias("stop"), value.alias("value"))
            return F.struct(span["stop"].alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return place

    def chunk(acc: Column, first: Column) -> Column:
        last = F.least(first + (CHUNK - 1), F.size(acc["found"]) - 1)
        part = F.aggregate(
            F.sequence(first, last), F.struct(acc["at"].alias("at"), F.array().cast(SPANS).alias("out")), step(acc))
        done = F.struct(part.alias("part"))["part"]
        return F.struct(done["at"].alias("at"), acc["found"].alias("found"), acc["gaps"].alias("gaps"),
                        F.concat(acc["out"], F.array(done["out"])).alias("out"))

    firsts = F.sequence(F.lit(0), F.size(found) - 1, F.lit(CHUNK))
    return F.when(F.size(found) > 0, F.aggregate(firsts, state, chunk, lambda acc: F.flatten(acc["out"]))).otherwise(
        F.array().cast(SPANS))
