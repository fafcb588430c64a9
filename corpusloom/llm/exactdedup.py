"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

One narrow scan takes each text's byte length and the hash of its first characters, and sums rows by both before
anything moves. A length that occurs once, and of the other lengths a prefix hash that occurs once, settles its text.
Only texts that share both with another are read whole and hashed with SHA-256. Which these are is told to the scan by a
table of slots, `max_keys` at most whatever the input: a (length, prefix) pair that is shared marks its slot. A text
that only meets a foreign mark is hashed without need, which costs time and changes nothing; so the work rises towards
hashing every text where shared pairs outnumber the slots, and no text moves.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing A-Z only; of equal
texts the largest doc_id stays (null only if all are null); very long texts are hashed whole; rows that repeat both
doc_id and text come out once each, exactly one of a group kept; an empty table gives an empty result; other columns,
whatever their names, pass through `dedup` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, cut, join_unique, temp

N, P, H, SLOT = temp("bytes"), temp("prefix"), temp("hash"), temp("slot")
#: Slots that are sent to every executor at most, 64 bytes each in memory.
MAX_KEYS = 500_000


def _split(docs: DataFrame, text_col: str, prefix_chars: int, max_keys: int) -> tuple[DataFrame, DataFrame]:
    """Rows that may share their (length, prefix hash) pair with another, and the settled rest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pair = {N: F.octet_length(text), P: F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars)))}
    slot = F.pmod(F.xxhash64(N, P), F.lit(max(1, max_keys)))
    shared = docs.select(*[c.alias(n) for n, c in pair.items()]).groupBy(N, P).agg(F.count("*").alias("c")).filter("c > 1")
    slots = F.broadcast(cut(shared.select(slot.alias(SLOT)).distinct()))
    rows = docs.withColumns(pair).withColumn(SLOT, slot)
    return rows.join(slots, SLOT, "left_semi"), rows.join(slots, SLOT, "left_anti")


def _full_hash(text_col: str):
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))


def _groups(hashed: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (hash, id) with their number of rows, and one row per hash. Both aggregate before they shuffle."""
    each = cut(hashed.groupBy(H, id_col).agg(F.count("*").alias(temp("m"))))
    groups = each.groupBy(H).agg(F.max(id_col).alias("keep_id"), F.sum(temp("m")).alias("group_size"), F.count("*").alias("rows"))
    return each, cut(groups)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, max_keys: int = MAX_KEYS) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept and the SHA-256 of the normalised text."""
    shared, settled = _split(docs.select(id_col, text_col), text_col, prefix_chars, max_keys)
    each, groups = _groups(shared.select(id_col, _full_hash(text_col).alias(H)), id_col)
    out = (
        join_unique(each, groups, H)
        .withColumn(temp("i"), F.explode(F.sequence(F.lit(1), F.col(temp("m")).cast("int"))))
        .select(
            id_col,
            "keep_id",
            "group_size",
            ((F.col(temp("i")) == 1) & F.col(id_col).eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex(H)).alias("text_sha256"),
        )
    )
    return out.unionByName(
        settled.select(id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lower(F.hex(_full_hash(text_col))).alias("text_sha256"))
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, max_keys: int = MAX_KEYS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Settled rows don't move; of the others each text moves once."""
    shared, settled = _split(docs, text_col, prefix_chars, max_keys)
    shared = shared.withColumn(H, _full_hash(text_col))
    each = shared.groupBy(H, id_col).agg(F.count("*").alias(temp("m")))
    own = each.groupBy(F.col(H).alias(temp("h"))).agg(F.max(F.struct(F.col(id_col).alias("id"), F.col(temp("m")).alias("n"))).alias(temp("last")))  # nulls come first
    keep = cut(own.select(temp("h"), F.col(temp("last"))["id"].alias(temp("id")), F.col(temp("last"))["n"].alias(temp("n"))))
    kept = shared.join(keep, (F.col(H) == F.col(temp("h"))) & F.col(id_col).eqNullSafe(F.col(temp("id"))))
    if keep.filter(F.col(temp("n")) > 1).limit(1).count():  # rows that repeat id and text
        kept = kept.dropDuplicates([H])
    kept = kept.select(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.unionByName(settled.select(*[F.col(f"`{c}`") for c in docs.columns]))
