"""Sentences from rows of a training log. All expressions are built-in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

#: Accepted names of each canonical column, first match wins; fixed values.
COLUMN_ALIASES = {
    "date": ["date", "workout_date", "session_date", "day", "timestamp"],
    "exercise": ["exercise", "exercise_name", "movement", "lift", "activity"],
    "sets": ["sets", "num_sets", "set_count"],
    "reps": ["reps", "repetitions", "num_reps", "rep_count"],
    "weight": ["weight", "load", "resistance", "lbs", "kg", "weight_lbs", "weight_kg"],
    "rpe": ["rpe", "intensity", "effort", "rir"],
    "duration": ["duration", "time", "minutes", "seconds", "duration_min"],
    "distance": ["distance", "miles", "km", "meters"],
    "notes": ["notes", "comments", "remarks", "coach_notes"],
    "bodyweight": ["bodyweight", "bw", "body_weight"],
    "rest": ["rest", "rest_time", "rest_seconds", "rest_period"],
}
#: Upper bounds of perceived effort and their names; fixed values.
EFFORT = [(5.0, "low difficulty"), (7.0, "moderate difficulty"), (8.5, "high difficulty")]
MOST_EFFORT = "near-maximal effort"


def effort_band(rpe: Column) -> Column:
    band = F.lit(MOST_EFFORT)
    for bound, name in reversed(EFFORT):
        band = F.when(rpe <= bound, name).otherwise(band)
    return F.when(rpe.isNotNull(), band)


def long_date(value: Column) -> Column:
    """`January 05, 2024` for what reads as a date, else the value's text."""
    text = value.cast("string")
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "MMMM dd, yyyy"), text)


def whole(value: Column) -> Column:
    return value.try_cast("double").cast("long").cast("string")


def narrate_row(columns: Mapping[str, Column]) -> Column:
    """One sentence; `columns` maps canonical names to columns, and what is missing counts as null."""
    get = lambda name: columns.get(name, F.lit(None).cast("string"))
    text = lambda name: get(name).cast("string")
    said = lambda name, *parts: F.when(get(name).isNotNull(), F.concat(*parts))
    exercise = F.coalesce(strip(text("exercise")), F.lit("an exercise"))
    sets, reps = whole(get("sets")), whole(get("reps"))
    action = (
        F.when(
            get("sets").isNotNull() & get("reps").isNotNull(),
            F.concat(F.lit("the client performed "), sets, F.lit(" sets of "), reps, F.lit(" reps of "), exercise, F.coalesce(F.concat(F.lit(" at "), text("weight"), F.lit(" lbs")), F.lit(""))),
        )
        .when(get("sets").isNotNull(), F.concat(F.lit("the client performed "), sets, F.lit(" sets of "), exercise))
        .otherwise(F.concat(F.lit("the client performed "), exercise))
    )
    rpe = get("rpe").try_cast("double")
    note = strip(text("notes"))
    sentence = F.concat(
        F.concat_ws(
            ", ",
            said("date", F.lit("On "), long_date(get("date"))),
            action,
            said("duration", F.lit("for "), text("duration"), F.lit(" minutes")),
            said("distance", F.lit("covering "), text("distance")),
            said("rpe", F.lit("with an RPE of "), rpe.cast("string"), F.lit(", indicating "), effort_band(rpe)),
            said("rest", F.lit("with "), text("rest"), F.lit(" seconds of rest between sets")),
            F.when(note != "", F.concat(F.lit("(Note: "), note, F.lit(")"))),
        ),
        F.lit("."),
    )
    return F.concat(F.upper(F.substring(sentence, 1, 1)), F.substring(sentence, 2, 1 << 30))
