import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chunk, sections

PROSE = "Progress comes slowly. Add load each week! Rest well? Eat enough food. Sleep eight hours. Track every set."


def plain_book_heading(line):
    s = line.strip()
    n = len(s.split())
    opens = re.match(r"(Scientific Foundations|Practical/Applied|(Domain|Chapter|Section|Part)\s+\d)", s, re.I)
    return len(s) >= 3 and n <= 10 and any([opens, n >= 2 and s.isupper(), n >= 2 and s.istitle() and len(s) < 60])


@pytest.mark.parametrize("line", ["THE END", "The End", "It's A", "the end", "Chapter 5 of this", "chapter five", "A1 B2", "ÉTUDE DE", "Ab", "", "  Domain 3  ", "Of The And", "McDonald Farm", "X", "1 2 3", "Part 1 " + "w " * 12])
def test_book_heading(one, line):
    assert one(sections.is_book_heading, line) == plain_book_heading(line)


@pytest.mark.parametrize("line, expected", [("", False), ("CHAPTER ONE", True), ("Chapter 12 begins", True), ("1.2 Methods", True), ("1. Methods", True), ("1 Methods", False), ("plain text", False), ("A B C D E F G H I", False), ("X" * 101, False)])
def test_page_heading(one, line, expected):
    assert one(sections.is_page_heading, line) is expected


def test_split_by_headings(spark):
    body = "\n".join(["word " * 12] * 2)
    docs = spark.createDataFrame([(1, f"{body}\nFIRST PART\nSecond Part\n{body}\nThird Part\nshort"), (2, None), (3, "")], "id int, text string")
    got = sections.split_by_headings(docs).orderBy("id", "section_pos").collect()
    assert [(r["id"], r["title"]) for r in got] == [(1, "Untitled Section"), (1, "Second Part")]
    assert got[0]["section_text"] == body.strip()


def test_page_sections(spark):
    words = " ".join(f"word{chr(97 + i)}" for i in range(12))
    pages = spark.createDataFrame([("d", 1, f"{words}\nCHAPTER ONE\n{words}"), ("d", 2, f"{words}\n\n1.1 Next\n{words}"), ("d", 3, "  ")], "doc string, page int, text string")
    got = sections.page_sections(pages, "doc", "page", "text").orderBy("section_pos").collect()
    assert [(r["title"], r["start_page"]) for r in got] == [("Page 1", 1), ("CHAPTER ONE", 2), ("1.1 Next", None)]
    assert got[1]["section_text"] == f"{words}\n{words}\n"
    last = sections.page_sections(spark.createDataFrame([("e", 1, words)], "doc string, page int, text string"), "doc", "page", "text").first()
    assert (last["title"], last["start_page"]) == ("Final Section", None)


def plain_fold(text, budget, overlap, count):
    """The spans that the definition asks for: each as long as the budget lets it be, but with a new sentence at least;
    the next begins at the earliest sentence from which the rest is within the overlap."""
    parts = re.split(r"(?<=[.!?])\s+", text)
    sizes = [count(p) for p in parts]
    low, end, spans = 0, 0, []
    while end < len(parts):
        end += 1
        while end < len(parts) and sum(sizes[low : end + 1]) <= budget:
            end += 1
        spans.append(" ".join(parts[low:end]))
        low = min(j for j in range(low, end + 1) if sum(sizes[j:end]) <= overlap)
    return spans


def test_fold_matches_the_statement():
    rng = random.Random(1)
    for _ in range(300):
        text = " ".join("w " * rng.randint(0, 12) + rng.choice(".!?") for _ in range(rng.randint(0, 15)))
        for budget, overlap in ((5, 2), (20, 8), (10, 30), (1, 0)):
            assert chunk.fold(text, budget, overlap) == plain_fold(text, budget, overlap, chunk.estimate)


def test_chunk_prose(spark):
    rows = spark.createDataFrame([("s", 0, PROSE), ("s", 1, " "), ("s", 2, "One more. "), ("t", 0, None)], "source_id string, section_pos int, text string")
    got = chunk.chunk_prose(rows, budget=12, overlap=5).orderBy("chunk_index").collect()
    assert [r["chunk_id"] for r in got] == [f"s_chunk_{i:04d}" for i in range(len(got))]
    assert len(got) > 2 and got[-1]["text"] == "One more. "
    assert got[0]["text"].split(". ")[-1].rstrip("!") in got[1]["text"] or got[0]["text"].split("! ")[-1] in got[1]["text"]


def test_chunk_tabular(spark):
    rows = spark.createDataFrame([("s", i, f"t{i}") for i in range(12)], "source_id string, section_pos int, text string")
    got = chunk.chunk_tabular(rows).orderBy("chunk_index").collect()
    assert [r["text"].count("\n\n") for r in got] == [4, 4, 1]


def test_chunk_documents_and_totals(spark):
    rows = spark.createDataFrame([("p", "prose", 0, "T", PROSE, "prose"), ("q", "tabular", 0, "", "a b", "tabular"), ("q", "tabular", 1, "", "", "tabular")], "source_id string, doc_type string, section_pos int, title string, text string, content_type string")
    got = {r["chunk_id"]: r for r in chunk.chunk_documents(rows).collect()}
    assert got["p_chunk_0000"]["section_title"] == "T" and got["q_chunk_0000"]["text"] == "a b\n\n" and got["q_chunk_0000"]["topics"] == []
    totals = chunk.chunk_totals(chunk.chunk_documents(rows)).first()
    assert totals["chunks"] == 2
    empty = chunk.chunk_totals(chunk.chunk_documents(rows.filter(F.lit(False)))).first()
    assert (empty["total_tokens"], empty["avg_tokens"]) == (0, 0.0)


def test_chunks_by_a_tokenizer(spark):
    import public_tokenizers

    count = chunk.BpeCount(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join(f"Sentence number {i} tells of loads and rests." for i in range(60))
    docs = spark.createDataFrame([("s", 0, text), ("s", 1, text), ("t", 0, "One. Two.")], "source_id string, section_pos int, text string")
    got = chunk.chunk_prose(docs, budget=100, overlap=20, count=count).orderBy("source_id", "chunk_index").collect()
    want = [c for _ in range(2) for c in chunk.fold(text, 100, 20, count)]
    assert [r["text"] for r in got if r["source_id"] == "s"] == want and [r["chunk_index"] for r in got if r["source_id"] == "s"] == list(range(len(want)))
    assert all(r["token_count"] == count(r["text"]) for r in got) and len(want) > len(chunk.fold(text, 800, 100)) * 2


def test_sums_before(spark):
    from pyspark.sql import functions as F

    from corpusloom.operators.lineage import sums_before

    rows = spark.range(3000).selectExpr("IF(id % 10 = 0, NULL, 'hot') AS g", "id % 700 AS o", "id", "id % 3 AS v")
    got = sums_before(rows, "g", ["o", "id"], F.col("v"), "s").collect()
    want, sums = {}, {}
    for r in sorted(got, key=lambda r: (r["o"], r["id"])):
        want[r["id"]] = sums.get(r["g"], 0)
        sums[r["g"]] = sums.get(r["g"], 0) + r["v"]
    assert {r["id"]: r["s"] for r in got} == want and len(got) == 3000
