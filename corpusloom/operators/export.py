"""Chat-template text, the union of formats, and exact stratified splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.operators.lineage import cut

#: Marks of the chat template and its system message; fixed values.
BOS = "<|begin_of_text|>"
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>"
EOT = "<|eot_id|>"
SYSTEM_MESSAGE = (
    "You are a knowledgeable health and fitness professional with expertise in "
    "exercise science, strength and conditioning, nutrition, physical therapy, "
    "occupational therapy, and recovery. Provide accurate, evidence-based responses."
)
CONTINUE = "Continue the following: "
CLASSIFY = "Classify the following health/fitness text into the most appropriate category: "
LABELLED = "This text falls under the category of: "


def opening(role: Column) -> Column:
    return F.concat(F.lit(HEADER_START), role, F.lit(HEADER_END + "\n\n"))


def turn(role: Column, content: Column) -> Column:
    return F.concat(opening(role), content, F.lit(EOT))


def prologue(system: str = SYSTEM_MESSAGE) -> Column:
    return F.concat(F.lit(BOS), turn(F.lit("system"), F.lit(system)))


def exchange(user: Column, assistant: Column) -> Column:
    return F.concat(prologue(), turn(F.lit("user"), user), turn(F.lit("assistant"), assistant))


def qa_text() -> Column:
    return exchange(F.col("instruction"), F.col("response"))


def conversation_text() -> Column:
    return F.concat(prologue(), F.array_join(F.transform("messages", lambda m: turn(m["role"], m["content"])), ""))


def completion_text() -> Column:
    return exchange(F.concat(F.lit(CONTINUE), F.col("prompt")), F.col("completion"))


def classification_text() -> Column:
    return exchange(F.concat(F.lit(CLASSIFY + '"'), F.col("text"), F.lit('"')), F.concat(F.lit(LABELLED), F.col("label")))


def inference_prompt(prompt: Column) -> Column:
    return F.concat(prologue(), turn(F.lit("user"), prompt), opening(F.lit("assistant")))


#: Dataset type -> name of its format and its text; the order of the union.
FORMATTERS: dict[str, tuple[str, Callable[[], Column]]] = {
    "qa": ("qa", qa_text),
    "conversations": ("conversation", conversation_text),
    "completions": ("completion", completion_text),
    "classification": ("classification", classification_text),
}


def as_training_text(items: DataFrame, kind: str) -> DataFrame:
    name, text = FORMATTERS[kind]
    source = F.coalesce(F.col("source_id").cast("string"), F.lit("")) if "source_id" in items.columns else F.lit("")
    return items.select(text().alias("text"), F.lit(name).alias("format"), source.alias("source_id"))


def union_formats(datasets: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the datasets at hand, in the order of FORMATTERS."""
    out = None
    for kind in FORMATTERS:
        if kind in datasets:
            part = as_training_text(datasets[kind], kind)
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no dataset to prepare")
    return out


#: Rows of a small table that are sent to every executor at most.
MOST_SENT = 100_000


def _sent(table: DataFrame) -> DataFrame:
    table = cut(table)
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def stratified_split(examples: DataFrame, train: float = 0.8, validation: float = 0.1, seed: int = 42, stratum: str = "format", key: Column | None = None) -> DataFrame:
    """`examples` with `split`: in each stratum int(n * train) rows, int(n * validation) rows, and the rest for test.

    Rows are in the order of a seeded hash of their key, and all that is needed of it are the two hashes where a stratum
    passes from one split to the next. They are found by counts: first of the hash's leading digits, then of the hashes
    within the digits that hold a boundary. So texts stay where they are. Only where equal keys lie across a boundary,
    their rows are counted by all columns and dealt out by these counts, so a text that many rows share costs one row.
    """
    key = F.col("text") if key is None else key
    rows = examples.withColumn("__hash", F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))))
    narrow = cut(rows.select(F.col(stratum).alias("__s"), "__hash", F.substring("__hash", 1, 3).alias("__b")))
    holds = lambda goal: (F.col("__upto") - F.col("__n") < F.col(goal)) & (F.col(goal) <= F.col("__upto"))
    counts = narrow.groupBy("__s", "__b").agg(F.count("*").alias("__n"))
    counts = counts.withColumns({"__upto": F.sum("__n").over(Window.partitionBy("__s").orderBy("__b")), "__all": F.sum("__n").over(Window.partitionBy("__s"))})
    counts = counts.withColumn("__first", F.floor(F.col("__all") * F.lit(float(train))))
    counts = counts.withColumn("__second", F.col("__first") + F.floor(F.col("__all") * F.lit(float(validation))))
    near = counts.filter(holds("__first") | holds("__second"))  # two rows of a stratum at most
    near = _sent(near.select(F.col("__s").alias("__t"), F.col("__b").alias("__c"), (F.col("__upto") - F.col("__n")).alias("__before"), "__first", "__second"))
    inside = narrow.join(near, F.col("__s").eqNullSafe(F.col("__t")) & (F.col("__b") == F.col("__c")))
    hashes = inside.groupBy("__s", "__b", "__hash", "__before", "__first", "__second").agg(F.count("*").alias("__n"))
    hashes = hashes.withColumn("__upto", F.col("__before") + F.sum("__n").over(Window.partitionBy("__s", "__b").orderBy("__hash")))
    edges = cut(hashes.filter(holds("__first") | holds("__second")).withColumns({"__from": F.col("__upto") - F.col("__n"), "__train": holds("__first"), "__val": holds("__second")}))
    at = lambda flag, goal: F.max(F.when(F.col(flag), F.struct(F.col("__hash").alias("hash"), (F.col(goal) == F.col("__upto")).alias("whole"))))
    bounds = _sent(edges.groupBy(F.col("__s").alias("__t")).agg(at("__train", "__first").alias("__e1"), at("__val", "__second").alias("__e2")))
    met = rows.join(bounds, F.col(stratum).eqNullSafe(F.col("__t")), "left")
    up_to = lambda e: F.coalesce((F.col("__hash") < F.col(e)["hash"]) | ((F.col("__hash") == F.col(e)["hash"]) & F.col(e)["whole"]), F.lit(False))
    split = F.when(up_to("__e1"), "train").when(up_to("__e2"), "validation").otherwise("test")
    torn = lambda e: F.coalesce((F.col("__hash") == F.col(e)["hash"]) & ~F.col(e)["whole"], F.lit(False))
    across = torn("__e1") | (torn("__e2") & ~up_to("__e1"))
    out = met.filter(~across).select(*examples.columns, split.alias("split"))
    torn_edges = edges.filter((F.col("__train") & (F.col("__first") < F.col("__upto"))) | (F.col("__val") & (F.col("__second") < F.col("__upto"))))
    if not torn_edges.limit(1).count():
        return out
    equal = met.filter(across).groupBy(*examples.columns, "__hash").agg(F.count("*").alias("__m"))
    info = F.broadcast(edges.select(F.col("__s").alias("__t"), F.col("__hash").alias("__h"), "__from", "__first", "__second"))  # two rows of a stratum at most
    equal = equal.join(info, F.col(stratum).eqNullSafe(F.col("__t")) & (F.col("__hash") == F.col("__h")))
    last = F.col("__from") + F.sum("__m").over(Window.partitionBy(stratum, "__hash").orderBy(*examples.columns).rowsBetween(Window.unboundedPreceding, 0))
    equal = equal.withColumn("__last", last).withColumn("__start", F.col("__last") - F.col("__m"))
    within = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("__last"), hi) - F.greatest(F.col("__start"), lo))
    shares = {"train": within(F.lit(0), F.col("__first")), "validation": within(F.col("__first"), F.col("__second")), "test": within(F.col("__second"), F.col("__last"))}
    dealt = F.flatten(F.array(*[F.array_repeat(F.lit(name), n.cast("int")) for name, n in shares.items()]))
    return out.unionByName(equal.select(*examples.columns, F.explode(dealt).alias("split")))


def save_splits(examples: DataFrame, path: str) -> None:
    examples.write.mode("overwrite").partitionBy("split").json(path)
