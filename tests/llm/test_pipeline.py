import collections

import corpus_pipeline
from corpusloom.llm import exactdedup, langid, mixing, neardedup, packing
from corpusloom.llm.common import table
from corpusloom.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark, tmp_path):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    model = langid.fit(docs)
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels, scores = langid.predict_texts(model, [r["text"] for r in rows.values()])
    known = {i for i, label, s in zip(rows, labels, scores) if label != "und" and s >= corpus_pipeline.LEAST_SCORE}
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == known
    exact = exactdedup.dedup(got)
    groups = {}
    for i in known:
        key = rows[i]["text"].encode().lower()
        groups[key] = max(i, groups.get(key, -1))
    assert {r["doc_id"] for r in exact.collect()} == set(groups.values())
    near = neardedup.dedup(exact)
    classes = {r["class_id"] for r in neardedup.classes(exact).collect()}
    assert {r["doc_id"] for r in near.collect()} == classes
    mixed = corpus_pipeline.mixed(spark, near, SF)
    assert mixed.columns == docs.columns
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    final = packing.pack(mixed, tokenizer_path())
    firsts = collections.Counter(r["doc_id"] for r in final.filter("start = 0").collect())
    assert firsts == copies
    run = corpus_pipeline.run(spark, SF)
    key = lambda df: collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(run) == key(final)
    assert mixing.mix(near).count() == mixed.count()


def test_entry_lists_the_operators():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_stages_without_labels_and_empty(spark):
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents").limit(40).withColumn("lang", F.lit(None).cast("string")).withColumn("group", F.lit(1))
    assert corpus_pipeline.language(spark, docs, SF).count() == 40
    empty = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)
    odd = spark.createDataFrame([(1, None, "en", "s", None, 1), (1, "", None, None, None, 2), (1, "", None, None, None, 2), (2, "a word", "en", "s", 6, 3)], "doc_id long, text string, lang string, source string, n_chars long, keep_id int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        assert name == "packing" or out.columns == odd.columns
        assert out.count() >= (0 if name == "mixing" else 1)


def test_stage_tables_are_removed(spark):
    import os

    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    corpus_pipeline.run(spark, SF).count()
    assert not [n for n in os.listdir(folder) if n.startswith("pipeline-")]
