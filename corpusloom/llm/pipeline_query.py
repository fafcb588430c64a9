"""The query `pipeline`: the stages of corpus_pipeline.py at the repository's top."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
