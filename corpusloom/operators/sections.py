"""Sectioning of long texts by heading-like lines.

A text's lines are an array, so its sections are slices between heading positions: no shuffle, and no Python.
Pages of a paged document arrive as rows and meet once, grouped by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import WS, has_words, is_meaningful, strip

#: Openings that mark a heading whatever its case; fixed values.
OPENINGS = rf"(?i)^(Scientific Foundations|Practical/Applied|Domain{WS}+\p{{Nd}}|Chapter{WS}+\p{{Nd}}|Section{WS}+\p{{Nd}}|Part{WS}+\p{{Nd}})"


def is_upper(text: Column) -> Column:
    """str.isupper(): some cased letter, none in lower or title case."""
    return text.rlike(r"\p{Lu}") & ~text.rlike(r"[\p{Ll}\p{Lt}]")


def is_title(text: Column) -> Column:
    """str.istitle(): capitals start runs of cased letters and stand nowhere else."""
    return text.rlike(r"[\p{Lu}\p{Lt}]") & ~text.rlike(r"(^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}|[\p{Lu}\p{Ll}\p{Lt}][\p{Lu}\p{Lt}]")


def is_book_heading(line: Column) -> Column:
    return is_stripped_book_heading(strip(line))


def is_stripped_book_heading(s: Column) -> Column:
    """Cheap tests come first: long lines are ruled out by their length before any pattern, as ten words of a heading
    hold one gap at least."""
    return (F.length(s) >= 3) & ~has_words(s, 11) & (s.rlike(OPENINGS) | (has_words(s, 2) & (is_upper(s) | ((F.length(s) < 60) & is_title(s)))))


def is_page_heading(line: Column) -> Column:
    """For stripped lines of paged documents."""
    numbered = line.rlike(rf"^(Chapter|CHAPTER|Section|SECTION|Part|PART){WS}+\p{{Nd}}+") | line.rlike(rf"^\p{{Nd}}+\.\p{{Nd}}*{WS}+[A-Z]")
    return (line != "") & (F.length(line) <= 100) & ((is_upper(line) & ~has_words(line, 9)) | numbered)


def _marks(lines: Column, heading) -> Column:
    """-1 and the positions of the headings. The test runs over the lines themselves, each bound once."""
    found = F.transform(lines, lambda line, i: F.when(heading(line), i))
    return F.concat(F.array(F.lit(-1)), F.filter(found, lambda i: i.isNotNull()))


def _slices(lines: Column, marks: Column) -> Column:
    """array<struct(title, end, body)>: the stretch before the first heading (title null) and after each one."""
    return F.transform(
        F.arrays_zip(marks.alias("mark"), F.concat(F.slice(marks, F.lit(2), F.size(marks)), F.array(F.size(lines))).alias("end")),
        lambda s: F.struct(
            F.when(s["mark"] >= 0, F.get(lines, s["mark"])).alias("title"),
            s["end"].alias("end"),
            F.slice(lines, s["mark"] + 2, s["end"] - s["mark"] - 1).alias("body"),
        ),
    )


def _settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that later expressions read and don't compute again: a generator of one row is a boundary that
    projections aren't merged across."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def split_by_headings(docs: DataFrame, text_col: str = "text", min_words: int = 20) -> DataFrame:
    """`docs` exploded to sections: section_pos, title, section_text. Bodies under `min_words` words are left out."""
    made = docs.withColumn("__lines", F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"))
    made = _settled(made, "__marks", _marks(F.transform("__lines", strip), is_stripped_book_heading))
    made = made.select(*docs.columns, F.posexplode(_slices(F.col("__lines"), F.col("__marks"))).alias("section_pos", "__s"))
    made = _settled(made.withColumn("title", F.coalesce(strip(F.col("__s")["title"]), F.lit("Untitled Section"))), "section_text", strip(F.array_join(F.col("__s")["body"], "\n")))
    return made.filter(has_words(F.col("section_text"), min_words)).drop("__s")


def page_sections(pages: DataFrame, doc_col: str, page_col: str, text_col: str) -> DataFrame:
    """Sections across the cleaned pages (from 1) of each document: title, section_text and start_page.

    A section's page is the one on which the next heading closed it; the last section has none.
    """
    lines = F.transform(F.split(F.col(text_col), "\n"), lambda x: F.struct(F.col(page_col).alias("page"), strip(x).alias("line")))
    rows = pages.filter(strip(F.col(text_col)) != "").select(doc_col, F.struct(F.col(page_col).cast("int").alias("page"), lines.alias("lines")).alias("p"))
    docs = rows.groupBy(doc_col).agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["lines"])).alias("__all"))
    docs = docs.withColumns({"__lines": F.transform("__all", lambda x: x["line"])})
    docs = _settled(docs, "__marks", _marks(F.col("__lines"), is_page_heading))
    made = docs.select(doc_col, "__all", F.posexplode(_slices(F.col("__lines"), F.col("__marks"))).alias("section_pos", "__s"))
    page = F.get(F.col("__all"), F.col("__s")["end"])["page"]  # null after the last line
    title = F.coalesce(F.col("__s")["title"], F.when(page.isNotNull(), F.concat(F.lit("Page "), page.cast("string"))).otherwise(F.lit("Final Section")))
    made = made.select(doc_col, "section_pos", title.alias("title"), F.array_join(F.col("__s")["body"], "\n").alias("section_text"), page.cast("int").alias("start_page"), F.size(F.col("__s")["body"]).alias("__n"))
    return made.filter((F.col("__n") > 0) & is_meaningful(F.col("section_text"))).drop("__n")
