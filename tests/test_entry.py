import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from corpusloom.operators import generate
from corpusloom.plans import queries, toolkit
from corpusloom.sources import records
from corpusloom.sources.config import Settings

REPO = Path(__spark_entry__.__file__).parent
SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns == ["text_md5", "format", "source_id", "split"]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in ("region", "nation", "customer", "events", "documents", "pages", "benchmark", "labels", "conversations"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(set(queries.queries()) & set(__spark_entry__.oracle_sql())))
def test_query_against_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in found.fetchall()]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want))


def test_the_rest_stands_without_the_subpackage(tmp_path):
    shutil.copytree(REPO / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'chunk_prose' in q and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in (REPO / "corpusloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "corpusloom.llm" not in path.read_text()


def test_toolkit(spark):
    chunks = spark.createDataFrame([(f"c{i}", "s", "prose", f"text {i} goes here") for i in range(8)], "chunk_id string, source_id string, content_type string, text string")
    s = Settings()
    assert toolkit.preview(chunks, "qa", s, 2).count() == 2
    assert toolkit.test(chunks, "qa", s, generate.echo_factory, 3).filter("n_examples = 1").count() == 3
    got = {r["variant"]: r for r in toolkit.compare(chunks, "qa", s, generate.echo_factory, "Say {text}").collect()}
    assert got["A"]["examples"] == got["B"]["examples"] == 3
    assert toolkit.estimate(chunks, "qa", s, generate.echo_factory).first()["total_input"] > 0

    def failing():
        def run(system, user):
            raise OSError("down")

        return run

    with pytest.raises(RuntimeError):
        toolkit.estimate(chunks, "qa", s, failing)


def test_samples_and_counts(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"prompt": "p"}\n\n{"prompt": "q"}\n')
    (tmp_path / "b.json").write_text('[{"prompt": "r"},\n {"prompt": "s"}]')
    got = records.read_samples(spark, records.RECORDS["completions"], str(tmp_path / "a.jsonl"), str(tmp_path / "b.json"))
    assert sorted(r["prompt"] for r in got.collect()) == ["p", "q", "r", "s"]
    assert {r["file"]: r["records"] for r in records.file_counts(spark, str(tmp_path / "a.jsonl")).collect()} == {"a.jsonl": 2, None: 2}
