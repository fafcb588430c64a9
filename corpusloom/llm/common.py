"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that a lost executor costs no earlier stage.

    The folder is the one the cluster names in spark.checkpoint.dir. Only a local session (tests) makes one where that is
    unset; elsewhere executors could not read what others have written, so it is an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def text_slices(texts: pa.Array, rows: int = 256) -> Iterator[list[str | None]]:
    """The strings of an Arrow array, `rows` at a time: a batch may hold thousands of long texts, and only a slice of
    them is ever turned into Python strings. An empty array gives one empty slice."""
    for lo in range(0, max(1, len(texts)), rows):
        yield texts.slice(lo, rows).to_pylist()


#: Rows of a narrow table (a key and a few numbers, 64 bytes in memory) that are sent to every executor at most.
MOST_SENT = 250_000
#: Rows of a table of single numbers (80 bytes in memory as measured) that are sent to every executor at most.
MOST_KEYS = 1_000_000
#: Rows of one key from which on it is hot.
HOT_ROWS = 1000


def join_unique(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """`rows` joined with `facts`, which is materialised, has each key once and tells in `rows` how many rows have it.

    Hot keys, at most one for HOT_ROWS rows, meet by broadcast, or with a salt of the row if even they are too many to
    send; the others by one shuffle. So no task gets all rows of a key.
    """
    hot = facts.filter(F.col("rows") > HOT_ROWS).drop("rows")
    n = hot.count()
    rest = facts.filter(F.col("rows") <= HOT_ROWS).drop("rows")
    if not n:
        return rows.join(rest, key)
    if n <= MOST_SENT:
        few = F.broadcast(hot)
        return rows.join(few, key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key))
    salts, salt = 16, temp("salt")
    spread = facts.drop("rows").withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")).join(spread, [key, salt]).drop(salt)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the byte-wise built-in; translate() leaves other letters alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def temp(name: str) -> str:
    """A column name that input columns won't clash with."""
    return f"__cl_{name}"


def free(name: str, taken: list[str]) -> str:
    """`name`, with underscores at its end until no column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


class ChunkCache(dict):
    """White-space-delimited chunk -> bytes. Missing chunks are encoded by `encode`; `room` bounds the memory."""

    def __init__(self, encode, room: int = 150_000, longest: int = 48):
        super().__init__()
        self.encode, self.room, self.longest = encode, room, longest

    def __missing__(self, chunk: str) -> bytes:
        value = self.encode(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.room:
                self.clear()
            self[chunk] = value
        return value
