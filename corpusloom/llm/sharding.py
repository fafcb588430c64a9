"""Sharding by k-d tree partitioning (native).

Rows are points of metadata: id, size, source and language; rows of equal texts share the point of the one with the
smallest id, so a group of copies stays together but where a boundary of shards runs through it. A node that must hold k shards splits along the widest
side of its box at the weighted quantile that gives floor(k / 2) of k shards' bytes to the left, until a leaf holds
one shard, whose target is the total over the number of shards. Medians are found by radix descent over distributed
histograms: each pass sums bytes per node and bin of the next `BITS` key bits, and the driver sees nodes x 2^BITS sums
at most, whatever the input. Ties on the coordinate are ordered by text checksum and then by a hash of the row, so a
value or a group of copies that holds a third of all rows is cut at the right place too. The law `bytes` comes first: a
group is split at a boundary rather than moved whole.

Defined results: a null text has size `overhead` and checksum 0; null ids, sources and languages are points at the low
end; rows that repeat in every column are told apart by their place in the table and are dealt out like others; texts
of any length are measured whole; an empty table gives an empty result; only the named columns are read, so others may
have any name. Slots count from 0 in each shard without gaps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import cut, join_unique

BITS = 12
#: Bits of the sort key: coordinate, checksum, hash of the id.
WORDS = 3
WIDTH = 32


@dataclass
class Node:
    first: int  # its first shard
    shards: int
    weight: int
    box: list[list[int]]


def _pick(values: list[int]) -> Column:
    """The value of the row's node."""
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("node"))


def _widest(node: Node) -> int:
    return max(range(len(node.box)), key=lambda d: (node.box[d][1] - node.box[d][0], -d))


def _split(rows: DataFrame, nodes: list[Node], tolerance: float) -> tuple[DataFrame, list[Node]]:
    """Split every node of several shards; rows come back with their new node.

    All nodes descend together, a histogram pass for each digit that some node still needs.
    """
    dims = [_widest(n) for n in nodes]
    coordinates = F.array(*[F.col(f"d{d}") for d in range(len(nodes[0].box))])
    key = [F.get(coordinates, _pick(dims).cast("int")), F.col("crc"), F.col("h")]
    goals = [n.weight * (n.shards // 2) / n.shards for n in nodes]
    before, prefix, bounds, start = [0] * len(nodes), [0] * len(nodes), [(-1, 0, 0)] * len(nodes), 0
    open_ = {i for i, n in enumerate(nodes) if n.shards > 1}
    while open_:
        word, at = divmod(start, WIDTH)
        take = min(BITS, WIDTH - at)  # a digit never spans words
        inside = _pick([int(i in open_) for i in range(len(nodes))]) == 1
        for w in range(word):
            inside = inside & (key[w] == _pick([p >> (start - WIDTH * (w + 1)) & ((1 << WIDTH) - 1) for p in prefix]))
        if at:
            inside = inside & (F.shiftright(key[word], WIDTH - at) == _pick([p & ((1 << at) - 1) for p in prefix]))
        digit = F.shiftright(key[word], WIDTH - at - take).bitwiseAND(F.lit((1 << take) - 1).cast("long"))
        sums = rows.filter(inside).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("size")).collect()  # nodes x 2^BITS at most
        bins: dict[int, list[tuple[int, int]]] = {i: [] for i in open_}
        for r in sums:
            bins[r["node"]].append((r["digit"], r["size"]))
        for i in sorted(open_):
            value = size = 0
            for value, size in sorted(bins[i]):
                if before[i] + size >= goals[i]:
                    break
                before[i] += size
            else:  # rounding: all lies left of the goal
                before[i] -= size
            below, above = goals[i] - before[i], before[i] + size - goals[i]
            if min(below, above) <= tolerance or start + take == WORDS * WIDTH:
                whole = above <= below
                before[i] += size if whole else 0
                bounds[i] = _bound((prefix[i] << take) + value - (not whole), start + take)
                open_.discard(i)
            prefix[i] = (prefix[i] << take) + value
        start += take
    after: list[Node] = []
    left, right = [0] * len(nodes), [0] * len(nodes)
    for i, n in enumerate(nodes):
        left[i] = right[i] = len(after)
        if n.shards == 1:
            after.append(n)
            continue
        lows, highs, d, half = [list(b) for b in n.box], [list(b) for b in n.box], dims[i], n.shards // 2
        lows[d][1] = min(lows[d][1], max(lows[d][0], bounds[i][0]))
        highs[d][0] = max(highs[d][0], min(highs[d][1], bounds[i][0]))
        right[i] = len(after) + 1
        after += [Node(n.first, half, before[i], lows), Node(n.first + half, n.shards - half, n.weight - before[i], highs)]
    x, y, z = (_pick([b[w] for b in bounds]) for w in range(WORDS))
    goes_left = (key[0] < x) | ((key[0] == x) & ((key[1] < y) | ((key[1] == y) & (key[2] <= z))))
    return cut(rows.withColumn("node", F.when(goes_left, _pick(left)).otherwise(_pick(right)).cast("int"))), after


def _bound(number: int, bits: int) -> tuple[int, int, int]:
    """The largest key whose first `bits` bits are at most `number` (-1: a key below all)."""
    number = ((number + 1) << (WORDS * WIDTH - bits)) - 1
    mask = (1 << WIDTH) - 1
    return (number >> 2 * WIDTH & mask, number >> WIDTH & mask, number & mask) if number >= 0 else (-1, 0, 0)


def points(docs: DataFrame, id_col: str, text_col: str, dims: tuple[str, ...], overhead: int) -> DataFrame:
    """id, size, crc, h (a hash that tells rows apart), and the row's point: `point` (an id) and checksums d2, ..."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"d{i + 2}" for i in range(len(dims))]
    base = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.xxhash64(text).alias("group"),  # two texts that meet here only share a point
        *[F.when(F.col(c).isNull(), 0).otherwise(F.crc32(F.encode(F.col(c).cast("string"), "UTF-8"))).alias(n) for n, c in zip(names, dims, strict=True)],
        F.monotonically_increasing_id().alias("place"),
    )
    base = cut(base.withColumn("h", F.pmod(F.xxhash64("id", "crc", "place"), F.lit(1 << WIDTH))).drop("place"))
    firsts = cut(base.groupBy("group").agg(F.count("*").alias("rows"), F.min(F.struct("id", *names)).alias("first")))
    met = join_unique(base.drop(*names), firsts, "group")
    return cut(met.select("id", "size", "crc", "h", F.col("first.id").alias("point"), *[F.col(f"first.{n}").alias(n) for n in names]))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("source", "lang"), overhead: int = 8, slot_rows: int = 2048, tolerance: float = 1e-4) -> DataFrame:
    """id, size, text_crc32, law, shard, slot and grown_shard (null: the law is `bytes`) of every row."""
    base = points(docs, id_col, text_col, dims, overhead)
    top = F.lit((1 << WIDTH) - 1)
    out = ["id", "size", "crc", "shard"]
    sides = [f(f"d{i + 2}").alias(f"{n}{i + 2}") for i in range(len(dims)) for n, f in (("min", F.min), ("max", F.max))]
    s = base.agg(F.min("point").alias("lo"), F.max("point").alias("hi"), F.min("size").alias("least"), F.max("size").alias("most"), F.sum("size").alias("bytes"), *sides).first()  # one row
    lo, hi = s["lo"] if s["lo"] is not None else 0, s["hi"] if s["hi"] is not None else 0
    span = max(1, hi - lo)
    # ids and the logarithm of sizes are scaled to 32 bits, as the checksums of names are
    place = F.when(F.col("point").isNull(), 0).otherwise(F.least(top, ((F.col("point") - lo).cast("double") / span * ((1 << WIDTH) - 1)).cast("long")))
    scaled = F.least(top, (F.log2(F.col("size").cast("double")) / 48.0 * ((1 << WIDTH) - 1)).cast("long"))
    rows = base.withColumns({"d0": place, "d1": scaled})
    log = [int(math.log2(s[n] or 1) / 48.0 * ((1 << WIDTH) - 1)) for n in ("least", "most")]
    box = [[0, (1 << WIDTH) - 1 if hi > lo else 0], log, *([s[f"min{i + 2}"] or 0, s[f"max{i + 2}"] or 0] for i in range(len(dims)))]
    rows, nodes = rows.withColumn("node", F.lit(0)), [Node(0, shards, s["bytes"] or 0, box)]
    slack = max(1.0, (s["bytes"] or 0) / shards * tolerance)
    while s["bytes"] and any(n.shards > 1 for n in nodes):
        rows, nodes = _split(rows, nodes, slack)
    placed = rows.drop("point").withColumn("shard", _pick([n.first for n in nodes]).cast("int")).select(*out, "h")
    # slots: rows are numbered in buckets of a shard, and buckets get the rows before them
    buckets = max(1, -(-base.count() // (shards * slot_rows)))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("h", "crc"), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("h", "id", "crc", "size"))
    done = placed.withColumn("within", within).join(counts, ["shard", "bucket"])
    return done.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("within") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
