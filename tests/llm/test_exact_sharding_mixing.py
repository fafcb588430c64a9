import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import exactdedup, mixing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def rows(n=300, seed=1):
    rng = random.Random(seed)
    base = ["", "Alpha BETA", "alpha beta", "É", "é", "x" * 70 + "1", "x" * 70 + "2", "word " * 3000, None, "aa", "ab"]
    out = [(i, rng.choice(base), rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", None]), None) for i in range(n)]
    return [*out, out[3], out[3], (None, "Alpha BETA", "en", "a", 1), (None, "only null id", None, None, None), (None, "only null id", None, None, None)]


def norm(t):
    return (t or "").translate(UP)


@pytest.mark.parametrize("bound", [500_000, 0])
def test_exact_decisions(spark, bound):
    data = rows()
    docs = spark.createDataFrame(data, DOCS)
    groups = collections.defaultdict(list)
    for r in data:
        groups[norm(r[1])].append(r[0])
    got = exactdedup.decisions(docs, max_keys=bound).collect()
    assert len(got) == len(data)
    seen = collections.Counter()
    for r in got:
        key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r["text_sha256"])
        ids = [i for i in groups[key] if i is not None]
        assert r["group_size"] == len(groups[key]) and r["keep_id"] == (max(ids) if ids else None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        seen[key] += r["kept"]
    assert set(seen.values()) == {1}
    kept = exactdedup.dedup(docs, max_keys=bound)
    assert kept.columns == docs.columns
    assert sorted(norm(r["text"]) for r in kept.collect()) == sorted(groups)


def test_exact_clashing_names_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", 2, 3), (2, "A", 4, 5)], "doc_id long, text string, keep_id int, `c.d` int")
    assert [tuple(r) for r in exactdedup.dedup(docs).collect()] == [(2, "A", 4, 5)]
    assert exactdedup.decisions(docs.limit(0)).count() == 0
    assert exactdedup.dedup(docs.limit(0)).count() == 0


def test_sharding(spark):
    rng = random.Random(4)
    data = [(i if rng.random() < 0.9 else None, rng.choice(["hot " * 20, None, "", "é" * rng.randint(1, 300), "w " * rng.randint(1, 400)]), rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b"]), 0) for i in range(4000)]
    data += [(7, "again", "en", "a", 0)] * 1500  # one row many times
    got = sharding.shard(spark.createDataFrame(data, DOCS), slot_rows=50).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in data)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(24)) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    mean = sum(sizes.values()) / 24
    assert max(abs(s - mean) for s in sizes.values()) < 3 * 908
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_small(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    assert [(r["shard"] in range(24), r["slot"]) for r in sharding.shard(docs).collect()] == [(True, 0)]
    assert sharding.shard(docs.limit(0)).count() == 0
    assert sharding.shard(docs.withColumn("size", F.lit(1)).withColumn("shard", F.lit(2))).count() == 1


def poisson(u, rate):
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_poisson_inverse(spark):
    cases = [(u, r) for u in (0.0, 0.1, 0.5, 0.9, 0.999999) for r in (0.0, 0.3, 1.0, 7.5, 64.0)]
    df = spark.createDataFrame(cases, "u double, r double").select("u", "r", mixing.poisson_inverse(F.col("u"), F.col("r")).alias("k"))
    assert {(x["u"], x["r"]): x["k"] for x in df.collect()} == {(u, r): poisson(u, r) for u, r in cases}


def test_mixing(spark):
    data = [(i, f"t{i}", "en", "big" if i % 10 else None, 1) for i in range(2000)]
    docs = spark.createDataFrame(data, DOCS)
    got = mixing.mix(docs, weights={"big": 1.0}, other=1.0, total=4000)
    n = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n[None] - 2000) < 200
    u = lambda i, part: int(hashlib.md5(f"42:{i}:{part}".encode()).hexdigest()[:13], 16) / 2**52
    want = {i: poisson(u(i, 0), 4000 * 0.5 / (200 if s is None else 1800)) for i, _, _, s, _ in data}
    copies = collections.Counter(r["doc_id"] for r in got.collect())
    assert copies == {i: k for i, k in want.items() if k}
    rows_ = [(r["shuffle_key"], r["doc_id"]) for r in got.collect()]
    assert len({k for k, _ in rows_}) == len(rows_)
    ids = [i for _, i in rows_]
    assert abs(sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) - 0.5) < 0.05  # no trace of the order of ids
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_large_rate_and_names(spark):
    docs = spark.createDataFrame([(1, "a", 9), (None, None, 9)], "doc_id long, source string, copies int")
    got = mixing.mix(docs.withColumn("text", F.lit("x")), total=2000)
    assert {"copies", "copies_", "mean_rate", "copy"} <= set(got.columns)
    assert abs(got.count() - 2000) < 300


def test_equal_rows_are_dealt_evenly(spark):
    docs = spark.createDataFrame([(7, "again", "en", "a", 0)], DOCS).crossJoin(spark.range(6000)).drop("id")
    counts = sharding.shard(docs).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in counts) == [250] * 24


def plain_tree(rows, shards, dims):
    """A k-d tree over rows (size, coordinates, crc, h): shard of each, by sorting every node's rows."""
    box = [(min(r[1][d] for r in rows), max(r[1][d] for r in rows)) for d in range(dims)]
    out = {}

    def split(own, first, k, box):
        if k == 1:
            out.update({r: first for r in own})
            return
        d = max(range(dims), key=lambda i: (box[i][1] - box[i][0], -i))
        own = sorted(own, key=lambda r: (r[1][d], r[2], r[3]))
        goal, at, total = sum(r[0] for r in own) * (k // 2) / k, 0, 0
        while at < len(own) and total < goal:
            total += own[at][0]
            at += 1
        if at and total - goal > goal - (total - own[at - 1][0]):
            at -= 1
        edge = own[at - 1][1][d] if at else -1
        low, high = list(box), list(box)
        low[d], high[d] = (box[d][0], min(box[d][1], max(box[d][0], edge))), (max(box[d][0], min(box[d][1], edge)), box[d][1])
        split(own[:at], first, k // 2, low)
        split(own[at:], first + k // 2, k - k // 2, high)

    split(rows, 0, shards, box)
    return out


def test_sharding_against_a_plain_tree(spark):
    rng = random.Random(8)
    data = [(i, rng.choice(["hot " * 9, f"t{i % 70} " * 5, "w " * rng.randint(1, 300)]), rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b"]), 0) for i in range(1500)]
    docs = spark.createDataFrame(data, DOCS)
    made = sharding.points(docs, "doc_id", "text", ("source", "lang"), 8).collect()
    groups = collections.defaultdict(set)
    for r in made:
        groups[(r["size"], r["crc"])].add((r["point"], r["d2"], r["d3"]))
    assert all(len(g) == 1 for g in groups.values())  # equal texts share a point
    lo, hi = min(r["point"] for r in made), max(r["point"] for r in made)
    top = (1 << 32) - 1
    rows = [(r["size"], (min(top, int((r["point"] - lo) / (hi - lo) * top)), min(top, int(math.log2(r["size"]) / 48.0 * top)), r["d2"], r["d3"]), r["crc"], r["h"], r["id"]) for r in made]
    want = {r[4]: s for r, s in plain_tree(rows, 24, 4).items()}
    got = sharding.shard(docs, tolerance=0.0).collect()
    sizes, plain = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
        plain[want[r["doc_id"]]] += r["size"]
    assert sum(r["shard"] == want[r["doc_id"]] for r in got) >= 0.99 * len(got)  # a tolerance of one byte is left
    assert max(abs(sizes[s] - plain[s]) for s in range(24)) <= 700
    torn = collections.Counter(len({r["shard"] for r in got if r["text_crc32"] == c}) > 1 for c in {r["text_crc32"] for r in got})
    assert torn[True] <= 23  # a boundary tears one group of copies at most


def test_clashing_names_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "long " * 400_000, "en", "a", 1, 5, "x"), (2, "short", "en", "b", 1, 6, "y")], DOCS + ", shard int, rows string")
    assert {r["size"] for r in sharding.shard(docs).collect()} == {2_000_008, 13}
    mixed = mixing.mix(docs, total=60)
    assert {len(r["text"]) for r in mixed.collect()} == {2_000_000, 5} and mixed.columns[: len(docs.columns)] == docs.columns
    assert sorted(r["rows"] for r in exactdedup.dedup(docs).collect()) == ["x", "y"]
    twice = mixing.mix(docs.union(docs), total=400).groupBy("doc_id", "copy").count().collect()
    assert {r["count"] for r in twice} == {2}  # rows that share an id draw the same count
