"""The queries opN_<name> of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, exactdedup, html, langid, mixing, neardedup, packing, preference, sharding, urlfilter
from corpusloom.llm.common import table, temp

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled urls are those that a rule judges; the trees judge the others."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = pages.withColumn("m", urlfilter.match(urlfilter.host(F.col("url")), urlfilter.path(F.col("url")), RULES)).filter(F.col("m").isNotNull())
    model = urlfilter.train(ruled.select("url", (F.col("m")["verdict"] == "block").alias("blocked")))
    out = urlfilter.judge(pages, RULES, model)
    return out.select("page_id", *[F.col(temp(c)).alias(c) for c in ("host", "path", "rule", "verdict")], F.round(F.col(temp("p")), 6).alias("p_block"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.decisions(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.format_pairs(preference.mismatched_pairs(table(spark, sf_dir, "conversations")))
    return pairs.select("conv_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardedup.classes(table(spark, sf_dir, "documents")).drop("node", "comp")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    model = langid.fit(docs, F.coalesce(~held_out, F.lit(False)))
    found = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), langid.predictor(model)("text").alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh the square root of their rows; the epoch has as many rows as the table, on average."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corpusloom.llm import pipeline_query

    own = [op1_url_filter, op2_exact_dedup, op3_packing, op4_ann, op5_preference, op6_near_dedup, op7_langid, op8_mixing, op9_html_text, op10_sharding]
    return {f.__name__: f for f in own} | {"pipeline": pipeline_query.run}
