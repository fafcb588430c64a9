import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import similarity
from corpusloom.functions.similarity import ratio
from corpusloom.operators import quality

LONG = "this response has at least ten words so that it is kept"


def valid(spark, kind, row, schema):
    return spark.createDataFrame([row], schema).select(quality.validator(kind).alias("v")).first()["v"]


@pytest.mark.parametrize("q, a, ok", [("What is a squat", LONG, True), ("", LONG, False), ("  ", LONG, False), ("two words", LONG, False), ("What is a squat", "too short", False), (LONG, LONG, False), (None, LONG, False), ("What is a squat", None, False)])
def test_qa(spark, q, a, ok):
    assert valid(spark, "qa", (q, a), "instruction string, response string") is ok


@pytest.mark.parametrize(
    "turns, ok",
    [
        ([("user", "a"), ("assistant", "b")], True),
        ([("user", "a"), ("assistant", "b"), ("user", "c")], True),
        ([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], True),
        ([("assistant", "a"), ("user", "b")], False),
        ([("user", "a"), ("user", "b")], False),
        ([("user", "a"), (None, "b")], False),
        ([("user", "a"), ("assistant", " ")], False),
        ([("user", "a")], False),
        ([("system", "s"), ("user", "a"), ("assistant", "b")], False),
        (None, False),
    ],
)
def test_conversation(spark, turns, ok):
    assert valid(spark, "conversations", (turns,), "messages array<struct<role: string, content: string>>") is ok


def test_completion_and_classification(spark):
    assert valid(spark, "completions", ("p", LONG), "prompt string, completion string") is True
    assert valid(spark, "completions", ("", LONG), "prompt string, completion string") is False
    assert valid(spark, "completions", ("p", "short"), "prompt string, completion string") is False
    assert valid(spark, "classification", ("five words are in here", "x"), "text string, label string") is True
    assert valid(spark, "classification", ("five words are in here", " "), "text string, label string") is False
    with pytest.raises(ValueError):
        quality.validator("poems")


def greedy(keys, threshold=85.0):
    kept = []
    for pos, key in keys:
        if key and not any(ratio(key, other) > threshold for _, other in kept):
            kept.append((pos, key))
    return [pos for pos, _ in kept]


def random_keys(rng, n):
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.choice([3, 8, 15, 40, 90]))) for _ in range(n // 3)]
    out = []
    for _ in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(s) // 8))):
            at = rng.randrange(len(s) + 1)
            if rng.random() < 0.5:
                s.insert(at, rng.choice("abcdef "))
            elif s:
                s.pop(min(at, len(s) - 1))
        out.append("".join(s))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fuzzy_dedup_is_the_greedy_pass(spark, seed):
    keys = list(enumerate([*random_keys(random.Random(seed), 120), "", "same", "same"]))
    items = spark.createDataFrame(keys, "pos long, text string")
    pairs = {tuple(r) for r in quality.similar_pairs(items.filter("text <> ''").groupBy(F.col("text").alias("key")).agg(F.min("pos").alias("pos"))).collect()}
    first = {}
    for pos, key in keys:
        first.setdefault(key, pos)
    firsts = sorted((p, k) for k, p in first.items() if k)
    assert pairs == {(p, q) for i, (p, a) in enumerate(firsts) for q, b in firsts[i + 1 :] if ratio(a, b) > 85}
    got = sorted(r["pos"] for r in quality.fuzzy_dedup(items, F.col("text"), "pos").collect())
    assert got == greedy(keys)


def test_first_come_is_not_transitive(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    assert sorted(r["pos"] for r in quality.first_come(pairs).collect()) == [2, 5]


def test_fuzzy_dedup_fixtures(spark):
    near = [(0, "What are the benefits of progressive overload?"), (1, "What are the benefits of progressive overloading?"), (2, "How much protein is needed?")]
    assert quality.fuzzy_dedup(spark.createDataFrame(near, "pos long, k string"), F.col("k"), "pos").count() == 2
    assert quality.fuzzy_dedup(spark.createDataFrame([], "pos long, k string"), F.col("k"), "pos").count() == 0


def test_counters(spark):
    rows = [(0, "What is a squat", LONG), (1, "What is a squat", LONG), (2, "no", "no"), (3, "How do we train legs", LONG)]
    passed, stats = quality.validate_dataset(spark.createDataFrame(rows, "pos long, instruction string, response string"), "qa", "pos", 2)
    assert sorted(r["pos"] for r in passed.collect()) == [0, 3]
    assert tuple(stats.first()) == ("qa", 4, 1, 1, 2, 2)


@pytest.mark.parametrize("seed", [3, 4])
def test_blocks_and_strips_lose_no_pair(seed, monkeypatch):
    rng = random.Random(seed)
    keys = sorted({k for k in random_keys(rng, 150) + ["é😀 word", "é😀 words", "x"] if k})
    rng.shuffle(keys)
    strips = similarity._strips
    monkeypatch.setattr(similarity, "_strips", lambda keys: strips(keys, 40, 1500))
    for threshold in (60, 85):
        want = [(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if ratio(keys[i], keys[j]) > threshold]
        assert sorted(tuple(sorted(p)) for p in similarity.alike(keys, None, threshold)) == want
        assert sorted(similarity.alike(keys[:50], keys[50:], threshold)) == [(i, j - 50) for i, j in want if i < 50 <= j]


def test_pairs_of_many_keys_alike_in_language(spark):
    """Keys of few syllables share most of their trigrams; two thousand of them took minutes when these were joined on."""
    rng = random.Random(7)
    keys = ["".join(rng.choice(["er", "en", "ch", "ie", "un", "d ", "st ", "ge"]) for _ in range(rng.randint(40, 100))) for _ in range(1000)]
    items = spark.createDataFrame([(i, k) for i, k in enumerate(keys)] + [(i + 1000, k + " indeed") for i, k in enumerate(keys)], "pos long, key string")
    start = time.monotonic()
    assert {(i, i + 1000) for i in range(1000)} <= {tuple(r) for r in quality.similar_pairs(items).collect()}
    assert time.monotonic() - start < 60
