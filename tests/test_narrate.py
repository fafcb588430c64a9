import pytest
from pyspark.sql import functions as F

from corpusloom.functions.narrative import effort_band, narrate_row
from corpusloom.operators import narrate

LOG = "date string, exercise string, sets long, reps long, weight long, rpe double"
ROWS = [("2024-01-15", "Squat", 4, 6, 315, 8.0), ("2024-01-15", "Bench", 3, 8, 225, 7.5), ("2024-01-15", None, 3, 8, 185, 7.0), ("2024-01-17", "Row", None, None, None, None), (None, "Curl", 3, 10, 50, None)]


@pytest.fixture
def log(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], f"pos int, {LOG}")


def test_aliases():
    names = narrate.canonical_names(["Workout_Date", "exercise_name", "num_sets", "repetitions", "LOAD", "intensity", "custom"])
    assert list(names.values()) == ["date", "exercise", "sets", "reps", "weight", "rpe"]
    assert narrate.canonical_names(["lbs", "load"]) == {"load": "weight"}


def test_normalize_keeps_the_rest(spark):
    df = spark.createDataFrame([("a", "b", 1)], "movement string, custom_field string, day int")
    assert narrate.normalize_columns(df).columns == ["exercise", "custom_field", "date"]


def test_rows(log):
    got = [r["text"] for r in narrate.narrate_rows(log, "pos").orderBy("section_pos").collect()]
    assert got[0] == "On January 15, 2024, the client performed 4 sets of 6 reps of Squat at 315 lbs, with an RPE of 8.0, indicating high difficulty."
    assert "reps of an exercise at 185 lbs" in got[2]
    assert got[3] == "On January 17, 2024, the client performed Row."
    assert got[4] == "The client performed 3 sets of 10 reps of Curl at 50 lbs."


def test_unreadable_date_and_extras(spark):
    df = spark.createDataFrame([("someday", 3, "run", 30, "5 km", 60, " good ")], "date string, sets int, exercise string, duration int, distance string, rest int, notes string")
    line = df.select(narrate_row({c: F.col(c) for c in df.columns}).alias("x")).first()["x"]
    assert line == "On someday, the client performed 3 sets of run, for 30 minutes, covering 5 km, with 60 seconds of rest between sets, (Note: good)."


def test_sessions(log):
    got = narrate.narrate_sessions(log, "pos").orderBy("date").collect()
    assert [(r["title"], r["num_exercises"]) for r in got] == [("Training Session - January 15, 2024", 3), ("Training Session - January 17, 2024", 1)]
    assert got[0]["text"].startswith("Training session on January 15, 2024:\n  - On January 15, 2024, the client")
    assert got[0]["text"].endswith("\n\nSession summary: 2 exercises, 10 total sets across Squat, Bench.")
    assert "summary" not in got[1]["text"]


@pytest.mark.parametrize("rpe, band", [(4, "low"), (5, "low"), (6, "moderate"), (7, "moderate"), (8, "high"), (8.5, "high"), (9, "near-maximal"), (10, "near-maximal")])
def test_effort(spark, rpe, band):
    assert spark.range(1).select(effort_band(F.lit(float(rpe))).alias("x")).first()["x"].startswith(band)


def test_describe(spark):
    df = spark.createDataFrame([(i, "a" if i else None, i) for i in range(60)], "pos int, name string, n int")
    text = narrate.describe_frame(df, "pos").first()["text"].split("\n")
    assert text[:4] == ["Data with columns: name, n", "Total rows: 60", "", "n: 0"] and len(text) == 53
    table = narrate.describe_table(df, "pos", "t").first()["text"].split("\n")
    assert table[0] == "Database table 't' with 60 rows and columns: name, n." and len(table) == 22
    assert narrate.describe_records(df, "pos").first()["text"].startswith("Data with 60 records. Fields: name, n.\n\n")


def test_drop_empty(spark):
    df = spark.createDataFrame([(0, None, None), (1, "x", None)], "pos int, a string, b string")
    out = narrate.drop_empty(df, ("pos",))
    assert out.columns == ["pos", "a"] and out.count() == 1
