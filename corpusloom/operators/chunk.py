"""Chunks of prose by sentences within a token budget, and of tabular sections by fixed groups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import chunk_id, strip, token_count
from corpusloom.operators.lineage import cut, sums_before
from corpusloom.session import ship

SENTENCE_GAP = re.compile(r"(?<=[.!?])\s+")
TOKEN = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t-\r ]")


def estimate(sentence: str) -> int:
    """The offline estimate of functions.text.token_count."""
    return sum(1 for _ in TOKEN.finditer(sentence))


def fold(text: str, budget: int, overlap: int, count: Callable[[str], int] = estimate) -> list[str]:
    """Sentences gather until the next would pass the budget; the next chunk starts with the longest run of last
    sentences within the overlap. A sentence is never split, so a chunk may pass the budget. Each is counted once."""
    parts = SENTENCE_GAP.split(text)
    sizes = [count(p) for p in parts]
    chunks, start, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > budget:
            chunks.append(" ".join(parts[start:i]))
            again, total = i, 0
            while again > start and total + sizes[again - 1] <= overlap:
                again -= 1
                total += sizes[again]
            start = again
        total += size
    chunks.append(" ".join(parts[start:]))
    return chunks


class BpeCount:
    """Counts tokens by a tokenizer file, for `count` arguments; the file is loaded once in each Python worker."""

    loaded: dict = {}

    def __init__(self, path: str):
        self.path = path

    def __call__(self, text: str) -> int:
        if self.path not in BpeCount.loaded:
            from tokenizers import Tokenizer

            BpeCount.loaded[self.path] = Tokenizer.from_file(self.path)
        return len(BpeCount.loaded[self.path].encode(text, add_special_tokens=False).ids)


def prose_chunks(text: Column, budget: int = 800, overlap: int = 100, count: Callable[[str], int] = estimate) -> Column:
    """array<string>; the running sum that resets has no built-in form, so this is an Arrow UDF."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: fold(t, budget, overlap, count) if isinstance(t, str) else None)

    return F.pandas_udf(run, "array<string>")(text)


def counted(text: Column, count: Callable[[str], int]) -> Column:
    """Tokens of a text, by the built-in expression where `count` is the estimate."""
    if count is estimate:
        return token_count(text).cast("long")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: count(t) if isinstance(t, str) else None).astype("Int64")

    return F.pandas_udf(run, "long")(text)


def chunk_prose(
    sections: DataFrame, source_col: str = "source_id", order_col: str = "section_pos", text_col: str = "text", budget: int = 800, overlap: int = 100, count: Callable[[str], int] = estimate
) -> DataFrame:
    """Chunks of the non-blank sections of each source, numbered across its sections; other columns pass through.

    `count` gives the tokens of a text (`BpeCount` for those of a tokenizer file). Numbers need only the count of chunks
    per section: it is summed over narrow rows, and each section with its chunks meets its number by its own key.
    """
    ship(sections.sparkSession)
    rows = sections.filter(strip(F.col(text_col)) != "").withColumn("__chunks", prose_chunks(F.col(text_col), budget, overlap, count))
    rows = cut(rows.drop(text_col).withColumn("__row", F.monotonically_increasing_id()))
    narrow = rows.select("__row", F.col(source_col).alias("__source"), F.col(order_col).alias("__order"), F.size("__chunks").alias("__n"))
    before = sums_before(narrow, "__source", ["__order", "__row"], F.col("__n"), "__first").select("__row", "__first")
    out = rows.join(before, "__row").select(*[c for c in sections.columns if c != text_col], "__first", F.posexplode("__chunks").alias("__i", "text"))
    index = (F.col("__first") + F.col("__i")).cast("long")
    return out.withColumns({"chunk_index": index, "chunk_id": chunk_id(F.col(source_col), index), "token_count": counted(F.col("text"), count)}).drop("__first", "__i")


def chunk_tabular(sections: DataFrame, source_col: str = "source_id", order_col: str = "section_pos", text_col: str = "text", group: int = 5, count: Callable[[str], int] = estimate) -> DataFrame:
    """Fixed groups of sections in order, joined by a blank line; empty sections count. Ranks are made of narrow rows."""
    rows = cut(sections.select(source_col, order_col, text_col, F.monotonically_increasing_id().alias("__row")))
    narrow = rows.select("__row", F.col(source_col).alias("__source"), F.col(order_col).alias("__order"))
    ranks = sums_before(narrow, "__source", ["__order", "__row"], F.lit(1), "__rank").select("__row", "__rank")
    rows = rows.join(ranks, "__row").withColumn("__group", F.floor(F.col("__rank") / group))
    texts = rows.groupBy(source_col, "__group").agg(F.array_sort(F.collect_list(F.struct("__rank", F.coalesce(F.col(text_col), F.lit("")).alias("t")))).alias("ts"))
    text = F.array_join(F.transform("ts", lambda x: x["t"]), "\n\n")
    out = texts.select(source_col, F.col("__group").cast("long").alias("chunk_index"), text.alias("text"))
    return out.withColumns({"chunk_id": chunk_id(F.col(source_col), F.col("chunk_index")), "token_count": counted(F.col("text"), count)})


def chunk_documents(sections: DataFrame, budget: int = 800, overlap: int = 100, count: Callable[[str], int] = estimate) -> DataFrame:
    """Chunks of extracted sections (source_id, doc_type, section_pos, title, text, content_type).

    Documents of type `tabular` are grouped; all others are folded section by section.
    """
    prose = chunk_prose(sections.filter("doc_type <> 'tabular'"), budget=budget, overlap=overlap, count=count)
    prose = prose.select("chunk_id", "source_id", F.coalesce("content_type", F.lit("prose")).alias("content_type"), F.col("title").alias("section_title"), "text", "token_count")
    tabular = chunk_tabular(sections.filter("doc_type = 'tabular'"), count=count)
    tabular = tabular.select("chunk_id", "source_id", F.lit("tabular").alias("content_type"), F.lit(None).cast("string").alias("section_title"), "text", "token_count")
    return prose.unionByName(tabular).withColumn("topics", F.array().cast("array<string>"))


def chunk_totals(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"), F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_tokens"))
