"""Profiling queries over sections, chunks, generated records and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Right-closed length bins; fixed values.
LENGTH_BINS = [(0, 100), (100, 500), (500, 1000), (1000, 2000), (2000, 5000), (5000, 10000), (10000, 50000), (50000, None)]
#: Dollars per million tokens; fixed values.
INPUT_PRICE, OUTPUT_PRICE = 3.0, 15.0
#: Seconds between two calls.
PAUSE = 0.5


def bin_name(low: int, high: int | None) -> str:
    return f"({low}, {high}]" if high is not None else f"({low}, inf]"


def extraction_summary(sections: DataFrame, by: list[str]) -> DataFrame:
    """Sections and characters per key, with the grand total in a row of nulls."""
    return sections.rollup(*by).agg(F.count("*").alias("sections"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))


def length_histogram(df: DataFrame, length: Column) -> DataFrame:
    """bin_no, bin and count, zeros included; a length of 0 is in no bin. One aggregation, no join."""
    sums = [F.count(F.when((length > lo) & (F.lit(True) if hi is None else length <= hi), 1)).alias(f"b{i}") for i, (lo, hi) in enumerate(LENGTH_BINS)]
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("bin_no"), F.lit(bin_name(*b)).alias("bin"), F.col(f"b{i}").alias("count")) for i, b in enumerate(LENGTH_BINS)])
    return df.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")


def extremes(df: DataFrame, length: Column, pos_col: str) -> DataFrame:
    """The first shortest and first longest row: `which`, pos and length."""
    low = F.min(F.struct(length.alias("n"), F.col(pos_col).alias("pos")))
    high = F.max(F.struct(length.alias("n"), (-F.col(pos_col)).alias("pos")))
    one = df.agg(low.alias("lo"), high.alias("hi"))
    rows = F.array(
        F.struct(F.lit("shortest").alias("which"), F.col("lo.pos").cast("long").alias("pos"), F.col("lo.n").cast("long").alias("length")),
        F.struct(F.lit("longest").alias("which"), (-F.col("hi.pos")).cast("long").alias("pos"), F.col("hi.n").cast("long").alias("length")),
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def describe_number(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample deviation, min, linear quartiles, max."""
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    one = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), q.alias("q"), F.max(column).alias("max"))
    return one.select("count", "mean", "std", "min", F.get("q", 0).alias("p25"), F.get("q", 1).alias("p50"), F.get("q", 2).alias("p75"), "max")


def describe_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, count, unique, top and freq of each; ties for the top go to the smallest value."""
    out = None
    for c in columns:
        values = df.groupBy(F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n")).filter("v IS NOT NULL")
        one = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.count("*").alias("unique"), F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("t"))
        one = one.select(F.lit(c).alias("column"), "count", "unique", F.col("t.v").alias("top"), (-F.col("t.n")).alias("freq"))
        out = one if out is None else out.unionByName(one)
    return out


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


def split_profile(examples: DataFrame) -> DataFrame:
    """split, kind, value and count: formats and sources within each split."""
    kinds = F.array(F.struct(F.lit("format").alias("kind"), F.col("format").alias("value")), F.struct(F.lit("source").alias("kind"), F.col("source_id").alias("value")))
    return examples.select("split", F.explode(kinds).alias("k")).groupBy("split", "k.kind", "k.value").agg(F.count("*").alias("count"))


def run_summary(counts: DataFrame, key: str, value: str) -> DataFrame:
    """Totals by key, `SKIPPED` where there are none."""
    total = counts.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total"))
    return total.withColumn("status", F.when(F.col("total") == 0, "SKIPPED").otherwise("OK"))


def perplexity(losses: DataFrame, loss: str = "loss", tokens: str = "n_tokens") -> DataFrame:
    return losses.agg(F.exp(F.sum(F.col(loss) * F.col(tokens)) / F.sum(tokens)).alias("perplexity"))


def results_summary(results: DataFrame) -> DataFrame:
    """Of run results (examples count `n_examples`, `response_length`, `error`): counts and averages of successes."""
    ok = F.col("error").isNull()
    wins = F.count_if(ok)
    return results.agg(
        F.count("*").alias("chunks"),
        wins.alias("successful"),
        F.coalesce(F.sum(F.when(ok, F.col("n_examples"))), F.lit(0)).alias("examples"),
        F.avg(F.when(ok, F.col("n_examples").cast("double"))).alias("avg_examples"),
        F.avg(F.when(ok, F.col("response_length").cast("double"))).alias("avg_response_length"),
    )


def compare_prompts(results: DataFrame, variant: str = "variant") -> DataFrame:
    """Totals per prompt variant; averages are over results without error, or over one if all failed."""
    ok = F.col("error").isNull()
    sums = results.groupBy(variant).agg(
        F.coalesce(F.sum(F.when(ok, F.col("n_examples"))), F.lit(0)).alias("examples"),
        F.coalesce(F.sum(F.when(ok, F.col("response_length"))), F.lit(0)).alias("length"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("errors"),
    )
    return sums.select(variant, "examples", (F.col("length") / F.greatest("ok", F.lit(1))).alias("avg_response_length"), "errors")


def cost_estimate(sample: DataFrame, total_chunks: int) -> DataFrame:
    """From a sample's input_tokens_est, output_tokens_est and elapsed: tokens, dollars and minutes of a full run."""
    n = F.lit(float(total_chunks))
    avg = sample.agg(F.avg("input_tokens_est").alias("avg_input"), F.avg("output_tokens_est").alias("avg_output"), F.avg("elapsed").alias("avg_time"))
    out = avg.select("avg_input", "avg_output", (F.col("avg_input") * n).alias("total_input"), (F.col("avg_output") * n).alias("total_output"), ((F.col("avg_time") + PAUSE) * n / 60).alias("minutes"))
    return out.withColumns({"input_cost": F.col("total_input") / 1e6 * INPUT_PRICE, "output_cost": F.col("total_output") / 1e6 * OUTPUT_PRICE}).withColumn("total_cost", F.col("input_cost") + F.col("output_cost"))


def top_by(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; the rank limit runs before the shuffle too."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("__r") <= n).drop("__r")
