"""PDF files and scanned images. The engines that read them are plugged in; the rest is Spark.

An engine is a picklable callable. For PDF: bytes -> list of page texts, and (bytes, page number) -> text by OCR. For
images: bytes -> text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import full_clean, is_meaningful
from corpusloom.operators.sections import page_sections

SCANNED_BELOW = 50
IMAGES = r"(?i)\.(jpe?g|png|tiff?|bmp)$"


def read_pdf(spark: SparkSession, path: str, pages_of: Callable[[bytes], list[str]], ocr: Callable[[bytes, int], str] | None = None) -> DataFrame:
    """Sections across the pages of each PDF; pages with hardly any text go through `ocr` where it is given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                for i, text in enumerate(pages_of(bytes(data))):
                    rows.append((name, i + 1, ocr(bytes(data), i) if ocr and len(text.strip()) < SCANNED_BELOW else text))
            yield pd.DataFrame(rows, columns=["source_file", "page", "text"])

    pages = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "source_file string, page int, text string")
    made = page_sections(pages.withColumn("text", full_clean(F.col("text"))), "source_file", "page", "text")
    return made.select("source_file", "section_pos", "title", F.col("section_text").alias("text"), "start_page", F.lit("prose").alias("content_type"))


def read_images(spark: SparkSession, path: str, ocr: Callable[[bytes], str], engine: str = "custom") -> DataFrame:
    """One section per image with at least five meaningful words, of a file or of a folder's images in name order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"source_file": pdf["path"], "raw": [ocr(bytes(x)) for x in pdf["content"]]})

    files = spark.read.format("binaryFile").load(path).filter(F.col("path").rlike(IMAGES)).select("path", "content")
    made = files.mapInPandas(run, "source_file string, raw string").withColumn("text", full_clean(F.coalesce("raw", F.lit("")))).filter(is_meaningful(F.col("text"), 5))
    title = F.regexp_extract("source_file", r"([^/]+?)(\.[^./]*)?$", 1)
    return made.select("source_file", title.alias("title"), "text", F.lit(engine).alias("ocr_engine"), F.lit("prose").alias("content_type")).orderBy("source_file")
