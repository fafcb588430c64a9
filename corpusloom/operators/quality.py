"""Quality predicates and order-aware fuzzy deduplication of generated records."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.similarity import alike
from corpusloom.functions.text import has_words, strip
from corpusloom.operators.lineage import cut
from corpusloom.session import ship


def _text(name: str) -> Column:
    return strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def valid_qa(min_instruction_words: int = 3, min_response_words: int = 10) -> Column:
    q, a = _text("instruction"), _text("response")
    return (q != "") & (a != "") & has_words(q, min_instruction_words) & has_words(a, min_response_words) & (q != a)


def valid_conversation() -> Column:
    """At least two messages that alternate user, assistant, ... from a user on, none blank."""
    m = F.col("messages")
    turn = F.transform(m, lambda x, i: F.coalesce((x["role"] == F.when(i % 2 == 0, "user").otherwise("assistant")) & (strip(x["content"]) != ""), F.lit(False)))
    return F.coalesce((F.size(m) >= 2) & F.forall(turn, lambda ok: ok), F.lit(False))


def valid_completion(min_words: int = 10) -> Column:
    p, c = _text("prompt"), _text("completion")
    return (p != "") & (c != "") & has_words(c, min_words)


def valid_classification(min_words: int = 5) -> Column:
    t, label = _text("text"), _text("label")
    return (t != "") & (label != "") & has_words(t, min_words)


VALIDATORS: dict[str, Callable[[], Column]] = {"qa": valid_qa, "conversations": valid_conversation, "completions": valid_completion, "classification": valid_classification}


def validator(kind: str) -> Column:
    if kind not in VALIDATORS:
        raise ValueError(f"unknown dataset type: {kind}")
    return VALIDATORS[kind]()


def dedup_key(kind: str) -> Column:
    columns = {"qa": lambda: F.col("instruction"), "conversations": lambda: F.get(F.col("messages"), 0)["content"], "completions": lambda: F.col("prompt"), "classification": lambda: F.col("text")}
    return F.coalesce(columns[kind](), F.lit("")) if kind in columns else F.lit("")


#: Keys of a block, and their characters, at most about; and tasks to aim for where there are fewer keys.
BLOCK_KEYS, BLOCK_CHARS, TASKS = 8192, 1 << 23, 256


def _blocks(keys: DataFrame) -> list[tuple[int, int, int, int]]:
    """(shortest, longest, first block, blocks) of runs of lengths; keys of one length may fill several blocks."""
    counts = [tuple(r) for r in keys.groupBy(F.length("key").alias("l")).count().orderBy("l").collect()]
    n, chars = sum(c for _, c in counts), sum(x * c for x, c in counts)
    rows, room = min(BLOCK_KEYS, max(64, n / TASKS**0.5)), min(BLOCK_CHARS, max(1 << 14, chars / TASKS**0.5))
    runs: list[tuple[int, int, int, int]] = []
    lo, held, size, block = 0, 0, 0, 0
    for at, (x, c) in enumerate(counts):
        lo, held, size = (x, 0, 0) if not held else (lo, held, size)
        held, size = held + c, size + x * c
        if held >= rows or size >= room or at == len(counts) - 1:
            parts = max(1, round(held / rows), round(size / room)) if lo == x else 1
            runs.append((lo, x, block, parts))
            held, block = 0, block + parts
    return runs


def similar_pairs(keys: DataFrame, threshold: float = 85.0) -> DataFrame:
    """(a, b) of all distinct keys (key, pos), none empty, with Indel ratio over `threshold`; a comes first. Exact.

    Keys are dealt to blocks by length, and only blocks whose lengths allow a ratio over t meet: with la + lb characters
    it leaves fewer than (1 - t) (la + lb) insertions and deletions, so la > lb t / (2 - t). Two blocks are one task,
    which `similarity.alike` searches in bounded memory. The work still grows with the square of the number of keys.
    """
    spark = keys.sparkSession
    ship(spark)
    keys = cut(keys.select("key", F.col("pos").cast("long").alias("pos")))
    runs = _blocks(keys)
    reach = threshold / 100 / (2 - threshold / 100)
    blocks = [(first + i, lo, hi) for lo, hi, first, parts in runs for i in range(parts)]
    met = [(x, y) for x, _, longest in blocks for y, shortest, _ in blocks[x:] if longest >= reach * shortest - 1e-6]
    if not met:
        return spark.createDataFrame([], "a long, b long")
    tasks = spark.createDataFrame([(i, b, 1 if x == y else 2 * (b == y)) for i, (x, y) in enumerate(met) for b in {x, y}], "task int, block int, side int")
    bounds = spark.createDataFrame(runs, "lo long, hi long, first int, parts int")
    placed = keys.join(F.broadcast(bounds), F.length("key").between(F.col("lo"), F.col("hi")))
    placed = placed.select("key", "pos", (F.col("first") + F.pmod(F.xxhash64("pos"), F.col("parts"))).cast("int").alias("block"))
    rows = placed.join(F.broadcast(tasks), "block").select("task", "side", "key", "pos")

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] < 2], pdf[pdf["side"] > 0]
        within = pdf["side"].iloc[0] == 1  # one block by itself
        found = np.array(list(alike(left["key"].tolist(), None if within else right["key"].tolist(), threshold)), dtype=np.int64).reshape(-1, 2)
        p, q = left["pos"].to_numpy()[found[:, 0]], right["pos"].to_numpy()[found[:, 1]]
        return pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    # dealt by number, so that small tables aren't drawn together in a few tasks
    return rows.repartition(min(len(met), 2000), "task").groupBy("task").applyInPandas(over, "a long, b long")


def first_come(pairs: DataFrame) -> DataFrame:
    """(pos) of the keys of `pairs` (a < b) that an in-order greedy pass drops.

    A key is dropped if an earlier neighbour is kept and kept once all earlier neighbours are dropped; each round
    settles at least the first open key of every chain. This is not the transitive closure.
    """
    pairs = cut(pairs)
    state = cut(pairs.select(F.col("a").alias("pos")).union(pairs.select("b")).distinct().withColumn("kept", F.lit(None).cast("boolean")))
    while state.filter("kept IS NULL").limit(1).count():
        seen = pairs.join(state.withColumnRenamed("pos", "a"), "a").groupBy("b").agg(F.max(F.col("kept").cast("int")).alias("any_kept"), F.max(F.col("kept").isNull().cast("int")).alias("any_open"))
        now = state.join(seen.withColumnRenamed("b", "pos"), "pos", "left")
        verdict = F.when(F.col("any_kept") == 1, F.lit(False)).when(F.coalesce("any_open", F.lit(0)) == 0, F.lit(True))
        state = cut(now.select("pos", F.coalesce("kept", verdict).alias("kept")))
    return state.filter("NOT kept").select("pos")


def fuzzy_dedup(items: DataFrame, key: Column, pos_col: str, threshold: float = 85.0) -> DataFrame:
    """`items` in which no key is over `threshold` like an earlier kept one; rows with an empty key are dropped.

    Equal keys collapse first, so a key that many rows share costs one node.
    """
    rows = items.withColumn("__key", key).filter("__key <> ''")
    firsts = cut(rows.groupBy(F.col("__key").alias("key")).agg(F.min(pos_col).cast("long").alias("pos")))
    gone = first_come(similar_pairs(firsts, threshold))
    kept = firsts.select("pos").join(gone, "pos", "left_anti")
    return rows.join(kept.select(F.col("pos").alias("__first")), F.col(pos_col) == F.col("__first"), "left_semi").drop("__key")


def validate_dataset(items: DataFrame, kind: str, pos_col: str, format_errors: int = 0, threshold: float = 85.0) -> tuple[DataFrame, DataFrame]:
    """The records that pass, and one row of counters. Records with an empty key vanish uncounted."""
    items = cut(items)
    good = cut(items.filter(validator(kind)))
    passed = cut(fuzzy_dedup(good, dedup_key(kind), pos_col, threshold))
    total, n_good, n_passed = items.count(), good.count(), passed.count()
    empty = good.filter(dedup_key(kind) == "").count()
    stats = items.sparkSession.createDataFrame(
        [(kind, total, n_good - n_passed - empty, total - n_good, format_errors, n_passed)],
        "dataset string, total long, duplicates_removed long, low_quality_removed long, format_errors_removed long, passed long",
    )
    return passed, stats
