"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its target share of the epoch over its rows. A document's count is the
inverse Poisson distribution at a uniform number hashed from seed and id, so a rerun makes the same epoch and a new
seed another one. Documents are repeated by their count, and a hash over all copies deals them to partitions and orders
them there.

Rates above `step` are split into equal parts with a hash each, whose counts add up to the same distribution; this
keeps exp(-rate) far from underflow and the inversion short.

Defined results: null sources form a source of their own; a source without a weight gets `other`; texts are carried
whole, whatever their length, and null ones stay null; rows that repeat an id draw the same count; an empty table gives
an empty result; added columns give way to columns of the same name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, free, temp


#: Rates of sources that are sent to every executor at most.
MOST_SOURCES = 20_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def poisson_inverse(u: Column, rate: Column) -> Column:
    """The smallest k whose Poisson distribution function at `rate` exceeds u."""
    return invert(poisson_function(rate), u)


def poisson_function(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ..., far enough for any u below 1, by summing terms upwards."""
    longest = (rate + 12.0 * F.sqrt(rate) + 40.0).cast("int")
    state = F.aggregate(
        F.sequence(F.lit(1), longest),
        F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c")),
        lambda s, i: F.struct((s["p"] * rate / i).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * rate / i)).alias("c")),
    )
    return state["c"]


def invert(function: Column, u: Column) -> Column:
    """How many values of a distribution function don't exceed u."""
    return F.least(F.size(F.filter(function, lambda c: c <= u)), F.size(function) - 1)


def rates(docs: DataFrame, source_col: str, weights: Mapping[str, float] | None, other: float, total: int | None, power: float, step: float) -> DataFrame:
    """source, mean rate and the parts that it is drawn in. Without `weights` a source weighs its rows to the power
    `power`."""
    rows = docs.groupBy(F.col(source_col).alias(temp("source"))).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        weight = F.lit(float(other))
        for name, value in weights.items():
            weight = F.when(F.col(temp("source")) == name, F.lit(float(value))).otherwise(weight)
    rows = rows.withColumn("w", weight)
    all_n, all_w = rows.agg(F.sum("n"), F.sum("w")).first()  # two numbers
    goal = float(total if total is not None else all_n or 0)
    return rows.select(temp("source"), (F.lit(goal) * F.col("w") / F.lit(float(all_w or 1.0) or 1.0) / F.col("n")).alias(temp("rate"))).withColumn(
        temp("parts"), F.greatest(F.lit(1), F.ceil(F.col(temp("rate")) / step).cast("int"))
    )


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: Mapping[str, float] | None = None, other: float = 0.0, total: int | None = None, power: float = 0.5, seed: int = 42, step: float = 64.0, shuffle: bool = True) -> DataFrame:
    """`docs` with each row repeated by its Poisson count, plus mean_rate, copies, copy (from 0) and shuffle_key.

    An added column whose name `docs` has already gets underscores at its end.
    """
    table = cut(rates(docs, source_col, weights, other, total, power, step))
    table = table.withColumn(temp("function"), poisson_function(F.col(temp("rate")) / F.col(temp("parts"))))  # once for each source
    table = table if table.count() > MOST_SOURCES else F.broadcast(table)  # else texts move once more, by source
    met = docs.join(table, F.col(source_col).eqNullSafe(F.col(temp("source"))), "left")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    numbers = F.transform(F.sequence(F.lit(0), F.col(temp("parts")) - 1), lambda i: uniform(F.lit(str(seed)), key, i.cast("string")))
    counts = F.aggregate(F.transform(numbers, lambda u: invert(F.col(temp("function")), u)), F.lit(0), lambda a, x: a + x)
    met = met.withColumn(temp("copies"), counts).filter(F.col(temp("copies")) > 0)
    made = met.withColumn(temp("copy"), F.explode(F.sequence(F.lit(0), F.col(temp("copies")) - 1)))
    order = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), key, F.col(temp("copy")).cast("string")))
    added = {"mean_rate": F.col(temp("rate")), "copies": F.col(temp("copies")), "copy": F.col(temp("copy")), "shuffle_key": order}
    names = {name: free(name, docs.columns) for name in added}
    out = made.select(*[F.col(f"`{c}`") for c in docs.columns], *[c.alias(names[name]) for name, c in added.items()])
    if not shuffle:
        return out
    # the key is uniform, so hashing a part of it deals rows out evenly, without a sampling pass over the texts
    return out.repartition(F.substring(names["shuffle_key"], 1, 6)).sortWithinPartitions(names["shuffle_key"])
