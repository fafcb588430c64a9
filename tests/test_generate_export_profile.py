import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import export, generate, profile, sampling
from corpusloom.sources import registry
from corpusloom.sources.config import Settings

OBJ = '{"instruction": "q", "response": "a"}'


@pytest.mark.parametrize(
    "response, n, raw",
    [(f"[{OBJ}]", 1, 1), (OBJ, 1, 1), (f"```json\n[{OBJ},{OBJ}]\n```", 2, 2), (f"Here: {OBJ} and {OBJ}", 2, 2), ("nothing", 0, 0), (f"}} {OBJ}", 1, 1), ('{"a": "}"} {"b": 1}', 2, 2), ('{"a": {"b": 1}} {broken {"c": 2}', 2, 2), (f"```\n{OBJ}\nand\n{OBJ}\n```", 2, 2), ("", 0, 0), ("3", 1, 1)],
)
def test_parser(response, n, raw):
    assert len(generate.parse_response(response)) == n
    assert len(generate.parse_response(response, scan_raw=True)) == raw


def test_prompts(spark):
    s = Settings(topics=["x", "y"])
    chunks = spark.createDataFrame([("c1", "prose", "{n} raw {topics}"), ("c2", "tabular", "t")], "chunk_id string, content_type string, text string")
    got = {r["chunk_id"]: r["user_prompt"] for r in generate.with_prompts(chunks, "qa", s).collect()}
    assert got["c1"].startswith("Write 5 ") and got["c1"].endswith("{n} raw {topics}") and '{"instruction"' in got["c1"]
    assert "training log" in got["c2"]
    assert "x, y" in generate.with_prompts(chunks, "classification", s).first()["user_prompt"]
    own = generate.with_prompts(chunks, "qa", s, "Ask {n} of {text}!").orderBy("chunk_id").collect()
    assert own[1]["user_prompt"] == "Ask 5 of t!"


def broken_factory():
    def run(system, user):
        if "bad" in user:
            raise RuntimeError("no answer")
        return json.dumps([{"instruction": "q", "response": user[:5]}, {"instruction": "only"}])

    return run


def test_model_calls(spark):
    chunks = spark.createDataFrame([("c1", "s", None, "fine"), ("c2", "s", "prose", "bad")], "chunk_id string, source_id string, content_type string, text string")
    prompts = generate.with_prompts(chunks, "qa", Settings(), "{text}")
    responses = generate.call_model(prompts, broken_factory)
    assert [(r["chunk_id"], r["response"], r["content_type"]) for r in generate.records(responses, "qa").collect()] == [("c1", "fine", "prose")]
    results = {r["chunk_id"]: r for r in generate.run_results(responses).collect()}
    assert results["c2"]["error"] == "no answer" and results["c2"]["n_examples"] == 0 and results["c1"]["n_examples"] == 2
    summary = profile.results_summary(generate.run_results(responses)).first()
    assert (summary["chunks"], summary["successful"], summary["examples"]) == (2, 1, 2)


@pytest.mark.parametrize("n", [0, 1, 7, 10, 35])
def test_split_counts(spark, n):
    rows = spark.createDataFrame([(f"t{i}", "qa", "s") for i in range(n)] + [(f"u{i}", "completion", "s") for i in range(20)], "text string, format string, source_id string")
    got = export.stratified_split(rows, 0.8, 0.1)
    by = {(r["format"], r["split"]): r["count"] for r in got.groupBy("format", "split").count().collect()}
    train, val = int(n * 0.8), int(n * 0.1)
    assert [by.get(("qa", s), 0) for s in ("train", "validation", "test")] == [train, val, n - train - val]
    assert by[("completion", "train")] == 16
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in export.stratified_split(rows.repartition(3)).collect()}


def test_chat_text(spark):
    row = spark.createDataFrame([("q?", "a.")], "instruction string, response string").select(export.qa_text().alias("t")).first()["t"]
    assert row.startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nYou are") and row.endswith("<|start_header_id|>user<|end_header_id|>\n\nq?<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\na.<|eot_id|>")
    conv = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], "messages array<struct<role: string, content: string>>").select(export.conversation_text().alias("t")).first()["t"]
    assert conv.endswith("user<|end_header_id|>\n\na<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nb<|eot_id|>")
    label = spark.createDataFrame([("t", "l")], "text string, label string").select(export.classification_text().alias("t")).first()["t"]
    assert 'category: "t"<|eot_id|>' in label and label.endswith("category of: l<|eot_id|>")
    assert spark.range(1).select(export.inference_prompt(F.lit("p")).alias("t")).first()["t"].endswith("assistant<|end_header_id|>\n\n")
    with pytest.raises(ValueError):
        export.union_formats({})


def test_histogram_edges(spark):
    got = profile.length_histogram(spark.createDataFrame([(0,), (1,), (100,), (101,), (60000,)], "n int"), F.col("n")).orderBy("bin_no").collect()
    assert [r["count"] for r in got] == [2, 1, 0, 0, 0, 0, 0, 1]


def test_profile_small(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "n int, s string")
    d = profile.describe_number(df, "n").first()
    assert (d["count"], d["mean"], d["p25"], d["max"]) == (4, 2.5, 1.75, 4) and abs(d["std"] - 1.2909944) < 1e-6
    s = profile.describe_strings(df, ["s"]).first()
    assert (s["count"], s["unique"], s["top"], s["freq"]) == (3, 2, "a", 2)
    e = {r["which"]: r["pos"] for r in profile.extremes(df, F.lit(5), "n").collect()}
    assert e == {"shortest": 1, "longest": 1}
    losses = spark.createDataFrame([(1.0, 1), (2.0, 3)], "loss double, n_tokens int")
    assert abs(profile.perplexity(losses).first()["perplexity"] - 2.718281828 ** (7 / 4)) < 1e-6
    runs = profile.run_summary(spark.createDataFrame([("a", 0), ("b", 2)], "kind string, n int"), "kind", "n")
    assert {r["kind"]: r["status"] for r in runs.collect()} == {"a": "SKIPPED", "b": "OK"}


def test_sampling(spark):
    df = spark.createDataFrame([(f"c{i}", i) for i in range(9)], "chunk_id string, pos int")
    done = spark.createDataFrame([("c0",), ("c0",), ("c3",)], "chunk_id string")
    assert sampling.resume(df, done).count() == 7
    assert [r["pos"] for r in sampling.head(sampling.resume(df, done), "pos", 2).collect()] == [1, 2]
    a, b = ({r["chunk_id"] for r in sampling.random_sample(df, "chunk_id", 4, s).collect()} for s in (1, 1))
    assert a == b and len(a) == 4


def test_registry(spark, tmp_path):
    assert registry.load(spark, str(tmp_path / "none.yaml")).count() == 0
    (tmp_path / "r.yaml").write_text("sources:\n- {id: a, type: pdf, path: a.pdf, topics: [x, y]}\n- {id: b, type: floppy_disk, path: r.yaml}\n- {id: c, type: html, path: r.yaml, topics: [y]}\n")
    rows = registry.load(spark, str(tmp_path / "r.yaml"))
    assert sampling.by_topic(rows, "y").count() == 2 and sampling.by_type(rows, "pdf").count() == 1 and sampling.by_id(rows, "b").first()["priority"] == "normal"
    errors = sampling.registry_errors(registry.with_presence(rows, str(tmp_path))).orderBy("id").collect()
    assert [(r["id"], r["error"]) for r in errors] == [("a", "missing file: a.pdf"), ("b", "unknown type: floppy_disk")]
    assert set(registry.EXTRACTORS) == {"epub", "pdf", "html", "image_ocr", "spreadsheet", "csv", "xlsx", "tsv", "database", "sqlite", "json_db"}
    with pytest.raises(TypeError):
        registry.entries("sources:\n- {id: a, type: b, path: c, colour: red}")


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("llm: {model: m}\ngeneration: {qa_pairs_per_chunk: 9}\n")
    s = Settings.load(str(tmp_path / "c.yaml"))
    assert (s.model, s.max_tokens, s.count("qa_pairs_per_chunk"), s.count("other"), s.prompt("none")) == ("m", 2048, 9, 3, "")
    monkeypatch.delenv("SOME_KEY", raising=False)
    with pytest.raises(ValueError):
        Settings.api_key("SOME_KEY")


def test_split_of_equal_texts(spark):
    rows = spark.createDataFrame([("same", "qa", "a")] * 70 + [("same", "qa", "b")] * 30, "text string, format string, source_id string")
    got = {r["split"]: r["count"] for r in export.stratified_split(rows).groupBy("split").count().collect()}
    assert got == {"train": 80, "validation": 10, "test": 10}
    mixed = rows.limit(9).unionByName(spark.createDataFrame([(f"t{i}", None, None) for i in range(11)], rows.schema))
    got = {(r["format"], r["split"]): r["count"] for r in export.stratified_split(mixed).groupBy("format", "split").count().collect()}
    assert got[("qa", "train")] == 7 and got[(None, "train")] == 8 and got[(None, "validation")] == 1 and sum(got.values()) == 20


def test_named_factory():
    assert generate.named_factory("corpusloom.operators.generate:echo_factory") is generate.echo_factory
    with pytest.raises(ValueError):
        generate.named_factory("corpusloom.operators.generate:nothing")
