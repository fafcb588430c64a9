import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import ann, langid

WORDS = {"xx": "the and of with from shall", "yy": "der und nicht für schön über", "zz": "que los año niño está más"}


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(5, 200))), lang))
    return out


def test_pooled_matches_the_convolution():
    model = langid.train([(t.encode(), y) for _, t, y in texts(40, 1)], epochs=1)
    x = langid.windows([b"some text", b"x" * 600], 256)[0]
    plain = np.concatenate([model.conv(x, t).max(axis=1) for t in model.tables], axis=1)
    assert np.allclose(plain, model.pooled(x), atol=1e-4)


def test_gradient_step_lowers_the_loss():
    data = [(t.encode(), y) for _, t, y in texts(120, 2)]
    x = langid.windows([d[:256] for d, _ in data], 256)[0]

    def loss(epochs):
        m = langid.train(data, epochs=epochs)
        p = m.probabilities(x)
        return -np.log(p[np.arange(len(data)), [m.labels.index(y) for _, y in data]] + 1e-9).mean()

    assert loss(8) < loss(1) < 1.2


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(texts(600, 3), "doc_id long, text string, lang string")
    model = langid.fit(docs.filter("doc_id % 4 <> 2"))
    got = docs.filter("doc_id % 4 = 2").withColumn("p", langid.predictor(model)("text"))
    right = [r["lang"] == r["p"]["lang_pred"] for r in got.collect()]
    assert sum(right) >= 0.97 * len(right)


def test_langid_edges(spark):
    rows = [(1, None, None), (2, "", "xx"), (3, "123 !?", "xx"), (4, "the and of " * 20000, "xx"), (5, "üb", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train([(t.encode(), y) for _, t, y in texts(200, 4)])
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", langid.predictor(model)("text").alias("p")).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[4]["lang_pred"] == "xx" and 0 < got[4]["score"] <= 1 and got[5]["lang_pred"] in model.labels
    assert langid.fit(docs.limit(0)) is None
    assert docs.select(langid.predictor(None)("text").alias("p")).first()["p"]["lang_pred"] == "und"
    assert langid.predict_texts(model, ["the and"] * 3)[0] == ["xx"] * 3


def brute(data, k, is_query):
    ok = [(i, np.array(v, dtype="f8")) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ok = [(i, v) for i, v in ok if len(v) == 16]
    out = {}
    for i, v in ok:
        if is_query(i):
            s = sorted((-(v @ w) / np.sqrt((v @ v) * (w @ w)), j) for j, w in ok if j != i)
            out[i] = [(j, -x) for x, j in s[:k]]
    return out


def test_numbers_are_no_letters():
    model = langid.ByteCnn(["aa"], [np.zeros((2, 256, 1), "f4")], np.zeros(1, "f4"), np.zeros((1, 1), "f4"), np.zeros(1, "f4"), 256)
    assert langid.predict_texts(model, ["²", "½ ③ 7", "Ⅷ.", "_ 12", "² x", "½ª"]) == (["und"] * 4 + ["aa"] * 2, [0.0] * 4 + [1.0] * 2)


def test_hadamard():
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(ann.hadamard(ann.hadamard(x)), x) and np.allclose(np.linalg.norm(ann.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(16).astype("f4").tolist()) for i in range(1500)]
    data += [(2000 + i, data[7][1]) for i in range(300)]  # one vector many times
    data += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, []), (5005, [1.0]), (5006, [float("inf")] + [1.0] * 15), (None, data[1][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    want = brute(data, 5, lambda i: i % 50 == 0)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0, part_rows=200).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    vectors = dict(data)
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, s in near:
            a, b = (np.array(vectors[x], dtype="f8") for x in (q, i))
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-9
    assert [a for a, _ in got[2000]] == [7, 2001, 2002, 2003, 2004]


def test_ann_scores_doubles_as_they_are(spark):
    rows = [(0, [1.0, 1e-9]), (1, [1.0, 2e-9]), (2, [1e200, 1e200]), (3, [1.0, 1.0 + 1e-7])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") == 3).orderBy("rank").collect()
    near = {r["vec_id"]: r["score"] for r in got}
    v = {i: np.array(x) / max(x) for i, x in rows}
    want = {i: v[3] @ v[i] / np.linalg.norm(v[3]) / np.linalg.norm(v[i]) for i in (0, 1, 2)}
    assert set(near) == set(want) and all(abs(near[i] - want[i]) < 1e-12 for i in want)


def test_ann_small(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.search(few, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r["vec_id"], round(r["score"], 6)) for r in got] == [(2, 0.0), (1, -1.0)]
    assert ann.search(few.limit(0), F.lit(True)).count() == 0
    assert ann.search(few.limit(1), F.lit(True)).count() == 0
    assert ann.search(few, F.lit(False)).count() == 0


def test_tiny_vectors_lengths_and_names(spark):
    rows = [(0, [1e-300, 1e-300], 1), (1, [1e-300, 0.0], 2), (2, [5e-324, 0.0], 3), (3, [1.0, 2.0, 3.0], 4), (50, [3.0, 2.0, 1.0], 5), (7, None, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim int").withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    got = [(r["query_id"], r["vec_id"], round(r["score"], 12)) for r in ann.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, round(0.5**0.5, 12)), (0, 2, round(0.5**0.5, 12)), (50, 3, round(10 / 14, 12))]


def test_scores_equal_doubles(spark):
    rng = np.random.default_rng(4)
    data = [(i, (rng.standard_normal(16) * 10.0 ** rng.integers(-200, 150)).tolist()) for i in range(300)]
    got = ann.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    for r in got:
        a, b = (np.array(data[r[c]][1]) / np.abs(data[r[c]][1]).max() for c in ("query_id", "vec_id"))
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-15 * 4
    assert len(got) == 30


def test_share_of_candidates_falls():
    rng = np.random.default_rng(2)
    shares = []
    for n in (500, 2000, 8000):
        x = rng.standard_normal((n, 64))
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        index = ann.Index(x, n, 12, 7)
        found = index.candidates(unit[:40])
        score = unit[:40] @ unit.T
        score[np.arange(40), np.arange(40)] = -2
        near = np.argsort(-score, axis=1)[:, :5]
        shares.append(np.mean([len(f) for f in found]) / n)
        assert np.mean([np.isin(a, f).mean() for a, f in zip(near, found)]) >= 0.9
    assert shares[0] > shares[1] > shares[2] and shares[2] < 0.3


def test_recall_holds_for_a_million():
    rng, n = np.random.default_rng(5), 1_000_000
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    asked = unit(rng.standard_normal((80, 64), dtype="f4"))
    score, near = np.full((80, 5), -2.0), np.zeros((80, 5, 64))
    for _ in range(0, n, 100_000):
        x = unit(rng.standard_normal((100_000, 64), dtype="f4"))
        own = asked @ x.T
        best = np.argpartition(-own, 5, axis=1)[:, :5]
        score, near = np.concatenate([score, np.take_along_axis(own, best, 1)], axis=1), np.concatenate([near, x[best]], axis=1)
        best = np.argsort(-score, axis=1)[:, :5]
        score, near = np.take_along_axis(score, best, 1), np.take_along_axis(near, best[:, :, None], 1)
    found = ann.Index(near.reshape(-1, 64), n, 12, 7).candidates(unit(asked.astype("f8")))
    assert np.mean([np.isin(np.arange(5 * i, 5 * i + 5), f).mean() for i, f in enumerate(found)]) >= 0.9


def test_too_few_probes_are_noticed(spark):
    rng = np.random.default_rng(6)
    data = [(i, rng.standard_normal(32).tolist()) for i in range(1200)]
    want = brute32(data)
    got = {}
    for r in ann.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, part_rows=400, share=0.05).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert all(len(v) == 5 for v in got.values())
    assert np.mean([len(got[q] & want[q]) / 5 for q in want]) >= 0.9
    same = [(i, [1.0, float(i + 1)]) for i in range(60)] + [(100 + i, [2.0, 2.0 * (i + 1)]) for i in range(60)]  # scaled: other vectors, equal scores
    assert ann.search(spark.createDataFrame(same, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).count() == 20


def brute32(data):
    x = np.array([v for _, v in data])
    x /= np.linalg.norm(x, axis=1)[:, None]
    score = x @ x.T
    np.fill_diagonal(score, -2)
    return {i: set(np.argsort(-score[i])[:5].tolist()) for i in range(0, len(data), 50)}


def test_best_buckets_are_the_best():
    rng = np.random.default_rng(3)
    near = [rng.standard_normal((6, 8)) for _ in range(3)]
    got = ann.best_buckets(near, 20)
    total = (near[0][:, :, None, None] + near[1][:, None, :, None] + near[2][:, None, None, :]).reshape(6, -1)
    for row, t in zip(got, total):
        assert set(row.tolist()) == set(np.argsort(-t)[:20].tolist())
    x = rng.standard_normal((5, 13))
    signs = ann.rotations(13, 1, 1)[0]
    assert np.allclose(ann.rotated(x, signs), ann.rotated(x, signs, ann.rotation(signs)))


def test_langid_ties_names_and_batches(spark):
    model = langid.ByteCnn(["aa", "bb"], [np.zeros((2, 256, 1), "f4")], np.zeros(1, "f4"), np.zeros((1, 2), "f4"), np.zeros(2, "f4"), 256)
    docs = spark.createDataFrame([(i, "text", 1) for i in range(700)], "doc_id long, text string, lang_pred int")
    got = docs.withColumn("p", langid.predictor(model)("text")).collect()
    assert {(r["p"]["lang_pred"], r["p"]["score"], r["lang_pred"]) for r in got} == {("aa", 0.5, 1)}  # of equal scores the first label
