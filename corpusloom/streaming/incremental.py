"""Incremental cleaning and validation of arriving records with Structured Streaming.

Row-local steps run on the stream. Fuzzy deduplication depends on order and on all that was kept before, so it runs
per micro-batch: a batch is deduplicated by itself and against the keys kept so far, and its survivors are appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import full_clean, is_meaningful
from corpusloom.operators.quality import dedup_key, fuzzy_dedup, validator
from corpusloom.sources.records import CORRUPT, exists, parse_lines


def stream_records(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 64) -> DataFrame:
    """Records of the JSON-lines files that arrive under `path`; malformed lines are skipped."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return parse_lines(lines, schema).filter(f"{CORRUPT} IS NULL").drop(CORRUPT)


def clean_stream(stream: DataFrame, text_col: str = "text") -> DataFrame:
    cleaned = stream.withColumn(text_col, full_clean(F.col(text_col)))
    return cleaned.filter(is_meaningful(F.col(text_col)))


def valid_stream(stream: DataFrame, kind: str) -> DataFrame:
    return stream.filter(validator(kind))


def start_validation(stream: DataFrame, kind: str, output: str, checkpoint: str, threshold: float = 85.0) -> StreamingQuery:
    """Append what passes validation and is new to `output`; a batch that is run again replaces its own folder."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("__pos", F.monotonically_increasing_id() + F.lit(1 << 62))
        if exists(spark, output):
            kept = spark.read.parquet(output).filter(F.col("batch") < batch_id).drop("batch")
            rows = kept.withColumn("__pos", F.monotonically_increasing_id()).unionByName(rows)
        # earlier rows come first and were kept before, so they are kept again
        passed = fuzzy_dedup(rows, dedup_key(kind), "__pos", threshold)
        passed.filter(F.col("__pos") >= 1 << 62).drop("__pos").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return valid_stream(stream, kind).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time_col: str, key: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per key and tumbling window, closed by a watermark."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, window), key).agg(F.count("*").alias("count"))
