"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are rotated by three rounds of random signs and a fast Hadamard transform, and fall to the nearest signed
axis. A hash is the axes of `polytopes` independent rotations; there are `tables` such hashes. Vectors are dealt to
blocks by a hash of themselves, and each block indexes its own under all tables. Every query visits every block once:
it probes, table by table, the buckets whose axes sum up to the most, and the cosines of what it finds there are taken in
double precision from the original vectors. Each block returns its best, and the blocks' lists are merged.

The length of the hash and the number of probes follow the number of vectors (`effort`), so that the share of vectors
that a query meets falls as the table grows. Of a few queries each block also takes the exact nearest: where the probes
found less than `LEAST_RECALL` of these, all queries search again with more probes, and at last meet all vectors. What
moves is each distinct vector once and each query once for a block and search.

Equal vectors collapse to one with its k + 1 smallest ids: no other copy can be among the k nearest, as ties go to
the smaller id.

Defined results: vectors that are null, empty, zero or hold a null, NaN or infinite component take no part; vectors of
different lengths have no cosine and are no candidates of each other; rows with a null id take no part; rows that repeat
id and vector count once; with fewer than k candidates all that were found are returned, and a query whose probes found
fewer than k meets all vectors of its length; components are taken as they are, doubles too, and scaled by powers of
two where their squares would leave the range; only the id and the vector are read, so other columns may have any name;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.llm.common import MOST_SENT, cut
from corpusloom.session import ship

#: Vectors of a block at most, components of a block at most (64 MB as doubles), and the least vectors that are worth one.
BLOCK_ROWS, BLOCK_VALUES, LEAST_ROWS = 65_536, 1 << 23, 4_096
#: Share of the vectors that a query's probes aim at for 500 vectors, and the power of the number that it falls with.
SHARE, FALL = 0.5, 0.3
#: Recall that is reached, queries that it is measured by, how much wider the next search is, and how wide one is at most.
LEAST_RECALL, CHECKED, WIDER, WIDEST = 0.9, 64, 4, 16 * SHARE
#: Probes of a table at most; the longest hash that stays below it is taken.
MOST_PROBES = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two; keeps lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotations(dim: int, hashes: int, seed: int) -> np.ndarray:
    """Random signs (hashes, 3, width), width the next power of two."""
    width = 1 << max(0, (dim - 1).bit_length())
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (hashes, 3, width))


def rotation(signs: np.ndarray) -> np.ndarray:
    """The rotation by these signs as a matrix, from the fast transform of the unit vectors. Up to some hundred columns
    one product with it takes less time than the transforms of all rows."""
    unit = np.eye(signs.shape[1])
    for s in signs:
        unit = hadamard(unit * s)
    return unit


def rotated(x: np.ndarray, signs: np.ndarray, matrix: np.ndarray | None = None) -> np.ndarray:
    """(rows, 2 width): how near the rotated rows are to each signed axis; axis width + i is -e_i."""
    if matrix is not None:
        out = x @ matrix[: x.shape[1]]
    else:
        out = np.zeros((len(x), signs.shape[1]))
        out[:, : x.shape[1]] = x
        for s in signs:
            out = hadamard(out * s)
    return np.concatenate([out, -out], axis=1)


def effort(n: int, axes: int, tables: int, share: float = SHARE) -> tuple[int, int]:
    """Polytopes of a hash and probes of a table, for n vectors, 2 width axes and the share that is aimed at for 500."""
    share *= min(1.0, (500 / max(1, n)) ** FALL)
    polytopes = 1
    while share * axes ** (polytopes + 1) / tables <= MOST_PROBES:
        polytopes += 1
    return polytopes, max(1, min(axes**polytopes, round(share * axes**polytopes / tables)))


def best_buckets(near: list[np.ndarray], probes: int) -> np.ndarray:
    """(rows, probes): the buckets whose axes' nearness sums up to the most. near: an array for each polytope.

    Every start of a bucket among the best is among the best itself, so each polytope only extends what is left. The i-th
    best start with the j-th best axis has i * j - 1 buckets before it, so few of these need a look.
    """
    axes = near[0].shape[1]
    total, code = np.zeros((len(near[0]), 1)), np.zeros((len(near[0]), 1), dtype=np.int64)
    for x in near:
        first = np.argsort(-x, axis=1)[:, :probes]
        i, j = np.nonzero(np.outer(np.arange(1, total.shape[1] + 1), np.arange(1, first.shape[1] + 1)) <= probes)
        total = total[:, i] + np.take_along_axis(x, first, axis=1)[:, j]
        code = code[:, i] * axes + first[:, j]
        best = np.argsort(-total, axis=1)[:, :probes]
        total, code = np.take_along_axis(total, best, axis=1), np.take_along_axis(code, best, axis=1)
    return code


class Index:
    """The tables over the rows of x: the rows in the order of their buckets, and the buckets."""

    def __init__(self, x: np.ndarray, n: int, tables: int, seed: int, share: float = SHARE, step: int = 8192):
        self.x, self.norm = x, np.linalg.norm(x, axis=1)
        self.axes = 2 << max(0, (x.shape[1] - 1).bit_length())
        self.polytopes, self.probes = effort(n, self.axes, tables, share)
        self.signs = rotations(x.shape[1], tables * self.polytopes, seed).reshape(tables, self.polytopes, 3, -1)
        small = self.signs.shape[-1] <= 512
        self.matrices = [[rotation(s) if small else None for s in signs] for signs in self.signs]
        unit = x / self.norm[:, None]
        self.order, self.codes = [], []
        for signs, matrices in zip(self.signs, self.matrices, strict=True):
            code = np.zeros(len(x), dtype=np.int64)
            for s, m in zip(signs, matrices, strict=True):
                code = code * self.axes + np.concatenate([rotated(unit[lo : lo + step], s, m).argmax(axis=1) for lo in range(0, len(x), step)])
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.codes.append(code[order])

    def candidates(self, unit: np.ndarray) -> list[np.ndarray]:
        """The rows that the probes of each query find."""
        found = np.zeros(len(unit) * len(self.x), dtype=bool)
        for signs, matrices, order, codes in zip(self.signs, self.matrices, self.order, self.codes, strict=True):
            wanted = best_buckets([rotated(unit, s, m) for s, m in zip(signs, matrices, strict=True)], self.probes)
            low, high = (np.searchsorted(codes, wanted.ravel(), side) for side in ("left", "right"))
            count = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            found[np.repeat(np.repeat(np.arange(len(unit)), wanted.shape[1]), count) * len(self.x) + order[at]] = True
        pairs = np.flatnonzero(found)
        cuts = np.searchsorted(pairs, np.arange(1, len(unit)) * len(self.x))
        return [part % len(self.x) for part in np.split(pairs, cuts)]


def _matrix(column: pd.Series, kept: str) -> np.ndarray:
    """The vectors as doubles, scaled by powers of two so that squares of large or small components stay in range."""
    x = np.frombuffer(b"".join(column), dtype=kept).reshape(len(column), -1).astype("f8")
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) if kept == "<f8" else x


def _pack(kept: str):
    """Vectors as bytes of their own kind, so that nothing is rounded."""

    def run(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, dtype=kept).tobytes() for v in vectors])

    return F.pandas_udf(run, "binary")


EMPTY = {"qkey": "i8", "key": "i8", "score": "f8", "exact": "?"}


def _block(k: int, kept: str, tables: int, seed: int, share: float | None, chunk: int = 32):
    """A block's queries and rows -> the k + 1 best of each query, and of those to be checked also the `exact` ones.
    Without `share` all rows are candidates."""

    def run(keys, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            rows, queries = rows.sort_values("key"), queries.sort_values("key")
            x, asked = _matrix(rows["v"], kept), _matrix(queries["v"], kept)
            key, first, qkey = rows["key"].to_numpy(), rows["first_id"].to_numpy(), queries["key"].to_numpy()
            checked = queries["checked"].to_numpy(dtype=bool)
            index = None if share is None else Index(x, int(rows["n"].iloc[0]), tables, seed, share)
            norm, length = np.linalg.norm(x, axis=1), np.linalg.norm(asked, axis=1)

            def nearest(i: int, rows_of: np.ndarray | None, exact: bool) -> None:
                score = x @ asked[i] / norm if rows_of is None else x[rows_of] @ asked[i] / norm[rows_of]
                if not len(score):
                    return
                take = min(len(score), k + 1)
                near = np.flatnonzero(score >= np.partition(score, len(score) - take)[len(score) - take] - 1e-9 * length[i])
                near = near if rows_of is None else rows_of[near]
                cosine = np.einsum("ij,j->i", x[near], asked[i]) / (norm[near] * length[i])
                best = np.lexsort((first[near], -cosine))[:take]
                out.append(pd.DataFrame({"qkey": qkey[i], "key": key[near[best]], "score": cosine[best], "exact": exact}))

            for lo in range(0, len(asked), chunk):
                part = asked[lo : lo + chunk]
                found = [None] * len(part) if index is None else index.candidates(part / length[lo : lo + chunk, None])
                for i, rows_of in enumerate(found, lo):
                    nearest(i, rows_of, False)
                    if checked[i] and index is not None:
                        nearest(i, None, True)
        return pd.concat(out) if out else pd.DataFrame({c: np.array([], dtype=t) for c, t in EMPTY.items()})

    return run


def recall(found: DataFrame, k: int) -> float:
    """Share of the k exact nearest keys of the checked queries that were found; of equal scores any count."""
    other = found.filter("key <> qkey")
    place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score")))
    true = other.filter("exact").withColumn("r", place).filter(F.col("r") <= k).groupBy("qkey").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    near = other.filter("NOT exact").join(F.broadcast(true.select("qkey", "least")), "qkey").filter(F.col("score") >= F.col("least") - 1e-12).groupBy("qkey").agg(F.count("*").alias("c"))
    sums = true.join(near, "qkey", "left").agg(F.sum(F.least("n", F.coalesce("c", F.lit(0)))), F.sum("n")).first()
    return sums[0] / sums[1] if sums[1] else 1.0


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, tables: int = 12, seed: int = 7, part_rows: int = BLOCK_ROWS, share: float = SHARE) -> DataFrame:
    """query_id, rank (from 1), id, score: the k nearest other rows found for each row where `is_query` holds."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    kept = "<f4" if isinstance(vectors.select(vector_col).schema[0].dataType.elementType, T.FloatType) else "<f8"
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    # -0.0 equals 0.0; a key per distinct vector
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("key", F.xxhash64("v"))
    ids = cut(rows.groupBy("key", "id").agg(F.max("q").alias("q")))
    if not ids.filter("q").limit(1).count():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    low = ids.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("r") <= k + 1)
    low = low.groupBy("key").agg(F.min("id").alias("first_id"), F.array_sort(F.collect_list("id")).alias("ids"))
    once = rows.groupBy("key").agg(F.first("v").alias("v"))
    distinct = cut(once.join(low, "key").select("key", "first_id", "ids", F.size("v").alias("dim"), _pack(kept)("v").alias("v")))
    sizes = distinct.groupBy("dim").agg(F.count("*").alias("n")).withColumn(
        "blocks", F.greatest(F.ceil(F.col("n") / part_rows), F.ceil(F.col("n") * F.col("dim") / BLOCK_VALUES), F.least(F.lit(spark.sparkContext.defaultParallelism), F.ceil(F.col("n") / LEAST_ROWS))).cast("int")
    )
    sizes = cut(sizes)
    sizes = F.broadcast(sizes) if sizes.count() <= MOST_SENT else sizes  # a row for each length of vectors
    indexed = distinct.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    wanted = ids.filter("q").select("key", "id")
    some = wanted.select("key").distinct()
    some = some.join(F.broadcast(some.orderBy(F.xxhash64("key"), "key").limit(CHECKED).select("key", F.lit(True).alias("checked"))), "key", "left")
    asked = cut(distinct.join(some, "key").select("key", "dim", "v", F.coalesce("checked", F.lit(False)).alias("checked")))

    def met(queries: DataFrame, share: float | None) -> DataFrame:
        sent = queries.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        sent = sent.select(*[F.col(c).alias(c) for c in ("dim", "block", "key", "v", "checked")])  # both sides stem from one table
        own = indexed.select("dim", "block", "key", "v", "first_id", "n")
        return sent.groupBy("dim", "block").cogroup(own.groupBy("dim", "block")).applyInPandas(_block(k, kept, tables, seed, share), "qkey long, key long, score double, exact boolean")

    found = cut(met(asked, share))
    while share is not None and recall(found, k) < LEAST_RECALL:
        share = share * WIDER if share < WIDEST else None
        found = cut(met(asked, share))
    found = found.filter("NOT exact").drop("exact")
    # queries with too few candidates meet all vectors
    reach = found.join(distinct.select("key", F.size("ids").alias("c")), "key").groupBy("qkey").agg(F.sum("c").alias("c"))
    short = cut(asked.join(reach, F.col("key") == F.col("qkey"), "left").filter(F.coalesce("c", F.lit(0)) <= k).select("key", "dim", "v", "checked"))
    if short.limit(1).count():
        found = found.unionByName(met(short, None).drop("exact")).groupBy("qkey", "key").agg(F.max("score").alias("score"))
    lead = found.join(distinct.select("key", "first_id", "ids"), "key")
    lead = lead.withColumn("r", F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "first_id"))).filter(F.col("r") <= k + 1)
    near = lead.select("qkey", "score", F.explode("ids").alias("near_id"))
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "near_id"))).filter(F.col("r") <= k + 1).drop("r")
    met = wanted.withColumnRenamed("key", "qkey").join(near, "qkey").filter(F.col("id") != F.col("near_id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "near_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", F.col("near_id").alias("vec_id"), "score")
