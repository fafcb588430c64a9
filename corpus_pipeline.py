"""A corpus pipeline: language ID, exact and near deduplication, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`, in their order.

Defined results, for every stage: columns are read by their names in `documents` (doc_id, text, lang, source), and
further ones, whatever their names, are carried along; rows that repeat are rows of their own until exact deduplication;
an empty table gives an empty result. What a stage does with nulls, empty and very long texts and ties stands with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import exactdedup, langid, mixing, neardedup, packing
from corpusloom.llm.common import shared_folder, table, temp
from corpusloom.llm.queries import tokenizer_path

#: Texts whose best language gets less are rejected, as are those without letters.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; their lang stays as it is.

    Null, empty and letterless texts go. Very long texts are judged by all their windows. Of languages that score alike
    the first by name counts. Where no document has a lang there is nothing to learn from and no language to be rejected:
    all documents stay.
    """
    model = langid.fit(docs)
    if model is None:
        return docs
    judged = docs.withColumn(temp("lang"), langid.predictor(model)("text"))
    return judged.filter((F.col(temp("lang"))["lang_pred"] != "und") & (F.col(temp("lang"))["score"] >= LEAST_SCORE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays, a null one only if all are null. Null texts are equal to empty ones; of
    rows that repeat doc_id and text one stays."""
    return exactdedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the smallest doc_id stays. Texts without words are near to equal texts only."""
    return neardedup.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources reach weights of the square root of their rows, in random order. Null sources are
    a source; rows that share a doc_id get the same number of copies."""
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens. Null texts are empty and give the end id alone; long ones spread over sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("packing", packed)]

#: Trained, approximate and packing stages have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. A stage's table is removed when the next one's is written; the last stage has
    checkpointed its pieces when it returns, so its input goes too."""
    docs, base, old = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        at = f"{base}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        _remove(spark, old)
        old = at
    out = STAGES[-1][1](spark, docs, sf_dir)
    _remove(spark, old)
    return out


def _remove(spark: SparkSession, path: str | None) -> None:
    if path is not None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
