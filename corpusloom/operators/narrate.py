"""Tables of training logs as prose: by session, by row, or as a plain description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.narrative import COLUMN_ALIASES, long_date, narrate_row


def canonical_names(columns: list[str]) -> dict[str, str]:
    """Original name -> canonical name for the first alias of each that is present, whatever its case."""
    lower = {c.lower(): c for c in reversed(columns)}
    out: dict[str, str] = {}
    for name, aliases in COLUMN_ALIASES.items():
        hit = next((lower[a] for a in aliases if a in lower), None)
        if hit is not None:
            out[hit] = name
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """A projection: aliases renamed, all else and the order kept."""
    names = canonical_names(df.columns)
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def _known(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(f"`{c}`") for c in df.columns if c in COLUMN_ALIASES}


def narrate_rows(df: DataFrame, pos_col: str) -> DataFrame:
    """section_pos, title and text: a section for each row of an undated table."""
    df = normalize_columns(df)
    return df.select(F.col(pos_col).cast("long").alias("section_pos"), F.lit("Training Log Entry").alias("title"), narrate_row(_known(df)).alias("text"))


def narrate_sessions(df: DataFrame, pos_col: str) -> DataFrame:
    """A section for each date: date, title, text, num_exercises. Rows without a date are left out.

    The lines of one date are one text, so they meet in one task; sums and counts are made on the way there.
    """
    df = normalize_columns(df)
    known = _known(df)
    exercise = known.get("exercise", F.lit(None).cast("string")).cast("string")
    sets = known.get("sets", F.lit(None).cast("int")).try_cast("double").cast("long")
    rows = df.filter(F.col("date").isNotNull()).select(F.col("date"), F.struct(F.col(pos_col).cast("long").alias("pos"), narrate_row(known).alias("line"), exercise.alias("exercise")).alias("r"), sets.alias("sets"))
    by_date = rows.groupBy("date").agg(F.array_sort(F.collect_list("r")).alias("rs"), F.coalesce(F.sum("sets"), F.lit(0)).alias("sets"), F.count("*").alias("num_exercises"))
    name = long_date(F.col("date"))
    lines = F.array_join(F.transform("rs", lambda r: F.concat(F.lit("  - "), r["line"])), "\n")
    done = F.filter(F.transform("rs", lambda r: r["exercise"]), lambda e: e.isNotNull())
    summary = F.concat(F.lit("\n\nSession summary: "), F.size(done).cast("string"), F.lit(" exercises, "), F.col("sets").cast("string"), F.lit(" total sets across "), F.array_join(done, ", "), F.lit("."))
    text = F.concat(F.lit("Training session on "), name, F.lit(":\n"), lines, F.when((F.col("sets") != 0) & (F.size(done) > 0), summary).otherwise(""))
    return by_date.select(F.col("date").cast("string").alias("date"), F.concat(F.lit("Training Session - "), name).alias("title"), text.alias("text"), "num_exercises")


def narrate(df: DataFrame, pos_col: str) -> DataFrame:
    """Sessions where the table has dates, else rows: section_pos, title, text."""
    if "date" in canonical_names(df.columns).values():
        made = narrate_sessions(df, pos_col)
        return made.select(F.col("date"), F.col("title"), F.col("text"), F.col("num_exercises"))
    rows = narrate_rows(df, pos_col)
    return rows.select(F.format_string("%020d", "section_pos").alias("date"), "title", "text", F.lit(None).cast("long").alias("num_exercises"))


def drop_empty(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Without rows that are all null, then without columns that are; one pass counts the values of all columns."""
    own = [c for c in df.columns if c not in keep]
    df = df.dropna(how="all", subset=own)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(own)]).first()
    return df.select(*keep, *[F.col(f"`{c}`") for i, c in enumerate(own) if counts[i]])


def describe(df: DataFrame, pos_col: str, head: str, rows: int, blank_after_head: bool = True) -> DataFrame:
    """One row, `text`: the header with {n} and {columns} filled in, then the first `rows` rows as `name: value | ...`."""
    own = [c for c in df.columns if c != pos_col]
    cells = [F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string"))) for c in own]
    first = df.select(F.col(pos_col).alias("pos"), F.concat_ws(" | ", *cells).alias("line")).orderBy("pos").limit(rows)
    lines = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda r: r["line"]), "\n").alias("lines"))
    n = df.count()
    return lines.select(F.concat(F.lit(head.replace("{n}", str(n)).replace("{columns}", ", ".join(own)) + ("\n\n" if blank_after_head else "\n")), F.col("lines")).alias("text"))


# headers of descriptions: fixed values


def describe_frame(df: DataFrame, pos_col: str) -> DataFrame:
    return describe(df, pos_col, "Data with columns: {columns}\nTotal rows: {n}", 50)


def describe_table(df: DataFrame, pos_col: str, table: str) -> DataFrame:
    return describe(df, pos_col, f"Database table '{table}' with {{n}} rows and columns: {{columns}}.", 20)


def describe_records(df: DataFrame, pos_col: str) -> DataFrame:
    return describe(df, pos_col, "Data with {n} records. Fields: {columns}.", 20)
