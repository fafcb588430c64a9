"""Head and random samples, resume filters, and lookups in the registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.registry import EXTRACTORS


def head(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The first n rows in order; a limit before any costly step."""
    return df.orderBy(order_col).limit(n)


def resume(df: DataFrame, done: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows whose key no earlier output has."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def random_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement, the same for a seed: those with the smallest hashes."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def by_id(registry: DataFrame, source_id: str) -> DataFrame:
    return registry.filter(F.col("id") == source_id).limit(1)


def by_type(registry: DataFrame, kind: str) -> DataFrame:
    return registry.filter(F.col("type") == kind)


def by_topic(registry: DataFrame, topic: str) -> DataFrame:
    return registry.filter(F.array_contains("topics", topic))


def with_extractor(registry: DataFrame) -> DataFrame:
    """The extractor of each source's type, null if unknown. A map of eleven entries, so no join."""
    return registry.withColumn("extractor", F.try_element_at(F.create_map(*[F.lit(x) for kv in EXTRACTORS.items() for x in kv]), F.col("type")))


def registry_errors(registry: DataFrame, missing_col: str = "missing") -> DataFrame:
    """id and error of sources whose file is missing or whose type is unknown; a source may have both."""
    gone = registry.filter(F.col(missing_col)).select("id", F.concat(F.lit("missing file: "), F.col("path")).alias("error"))
    unknown = with_extractor(registry).filter("extractor IS NULL").select("id", F.concat(F.lit("unknown type: "), F.col("type")).alias("error"))
    return gone.unionByName(unknown)
