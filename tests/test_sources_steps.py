import json
import sqlite3
import zipfile

import pytest

from corpusloom.plans import steps
from corpusloom.sources import markup, paged, records, tabular
from corpusloom.sources.config import Settings
from corpusloom.streaming import incremental

WORDS = "Progressive overload is the gradual increase of stress placed upon the body during training"


def write_xlsx(path, sheets):
    with zipfile.ZipFile(path, "w") as z:
        names = list(sheets)
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(names))) + "</Relationships>")
        for i, n in enumerate(names):
            rows = ""
            for y, row in enumerate(sheets[n]):
                cells = ""
                for x, v in enumerate(row):
                    ref = f"{chr(65 + x)}{y + 1}"
                    if isinstance(v, str):
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
                    elif v is not None:
                        cells += f'<c r="{ref}"><v>{v}</v></c>'
                rows += f'<row r="{y + 1}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{rows}</sheetData></worksheet>")


def write_epub(path, items):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/book.opf"/></rootfiles></container>')
        z.writestr("OEBPS/book.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest>' + "".join(f'<item id="i{i}" href="{n}" media-type="application/xhtml+xml"/>' for i, n in enumerate(items)) + '<item id="css" href="a.css" media-type="text/css"/></manifest></package>')
        for n, html in items.items():
            z.writestr(f"OEBPS/{n}", html)


@pytest.mark.parametrize(
    "html, title, text",
    [
        (f"<title>T</title><body><nav>menu</nav><article><p>{WORDS}</p><footer>f</footer></article><p>out</p></body>", "T", WORDS),
        (f"<body><header>h</header><main>{WORDS}</main>x</body>", "name", WORDS),
        (f"<body><script>x()</script><p>{WORDS} &amp; more<aside>side</aside></p></body>", "name", None),
        ("<p>no body</p>", None, None),
        ("<body>too short</body>", None, None),
        (None, None, None),
    ],
)
def test_html(spark, html, title, text):
    from pyspark.sql import functions as F

    got = markup.html_sections(spark.createDataFrame([(html,)], "html string"), "html", F.lit("name")).collect()
    assert (got[0]["title"] if got else None) == title
    if text:
        assert got[0]["text"].split("\n")[0] == text


def test_files(spark, tmp_path):
    (tmp_path / "page.html").write_text(f"<html><body><article>{WORDS}</article></body></html>")
    assert markup.read_html(spark, str(tmp_path / "page.html")).first()["title"] == "page"
    long = "".join(f"<p>PART NUMBER {c}</p><p>{' '.join([WORDS] * 40)}</p>" for c in ("ONE", "TWO"))
    write_epub(tmp_path / "b.epub", {"c1.xhtml": f"<body><h2>Intro</h2><p>{WORDS}</p></body>", "c2.xhtml": f"<body>{long}</body>", "c3.xhtml": "<body>x</body>"})
    book = markup.read_epub(spark, str(tmp_path / "b.epub")).orderBy("item_pos", "section_pos").collect()
    assert [r["title"] for r in book] == ["Intro", "PART NUMBER ONE", "PART NUMBER TWO"]
    (tmp_path / "d.pdf").write_bytes(b"x")
    pages = paged.read_pdf(spark, str(tmp_path / "d.pdf"), lambda data: [f"CHAPTER ONE\n{WORDS}", "scan"], lambda data, i: WORDS).collect()
    assert [(r["title"], r["start_page"]) for r in pages] == [("CHAPTER ONE", None)] and pages[0]["text"].count("Progressive") == 2
    for n in ("b.PNG", "a.jpg", "c.txt"):
        (tmp_path / n).write_bytes(b"i")
    assert [r["title"] for r in paged.read_images(spark, str(tmp_path), lambda data: WORDS).collect()] == ["a", "b"]


def test_spreadsheets(spark, tmp_path):
    (tmp_path / "log.csv").write_text("workout_date,movement,num_sets,reps,empty\n2024-01-15,Squat,4,6,\n2024-01-15,Bench,3,8,\n2024-01-17,Row,3,5,\n,,,,\n")
    got = tabular.spreadsheet_sections(spark, str(tmp_path / "log.csv")).orderBy("section_order").collect()
    assert [r["title"] for r in got] == ["Training Session - January 15, 2024", "Training Session - January 17, 2024"]
    (tmp_path / "log.tsv").write_text("exercise\tsets\nSquat\t4\n")
    assert tabular.spreadsheet_sections(spark, str(tmp_path / "log.tsv")).first()["text"] == "The client performed 4 sets of Squat."
    write_xlsx(tmp_path / "w.xlsx", {"A": [["date", "exercise", "sets"], ["2024-02-01", "Squat", 3]], "B": [["exercise", "weight"], ["Row", 50.5], [None, None]]})
    sheets = tabular.spreadsheet_sections(spark, str(tmp_path / "w.xlsx"), None).collect()
    assert {(r["part"], r["title"]) for r in sheets} == {("A", "Training Session - February 01, 2024"), ("B", "Training Log Entry")}
    assert tabular.spreadsheet_sections(spark, str(tmp_path / "w.xlsx")).count() == 1
    (tmp_path / "n.csv").write_text("date,a b\n,one two three\n,four five six\n")
    assert tabular.spreadsheet_sections(spark, str(tmp_path / "n.csv")).first()["text"] == "The client performed an exercise."  # an empty date column is dropped first
    with pytest.raises(ValueError):
        tabular.spreadsheet_sections(spark, str(tmp_path / "x.doc"))


def test_databases(spark, tmp_path):
    with sqlite3.connect(tmp_path / "l.db") as db:
        db.execute("CREATE TABLE log (date TEXT, exercise TEXT, sets INT)")
        db.execute("INSERT INTO log VALUES ('2024-03-01', 'Squat', 3)")
        db.execute('CREATE TABLE "odd ""name" (date TEXT, a TEXT)')
        db.execute('INSERT INTO "odd ""name" VALUES (NULL, \'some words that are here\')')
        db.execute("CREATE TABLE empty (a INT)")
    got = {r["part"]: r for r in tabular.database_sections(spark, str(tmp_path / "l.db")).collect()}
    assert set(got) == {"log", 'odd "name'} and got['odd "name']["title"] == 'Table: odd "name'
    (tmp_path / "o.json").write_text(json.dumps({"log": [{"date": "2024-03-01", "exercise": "Squat"}], "about": WORDS, "n": 3, "short": "x"}))
    made = {r["part"]: r for r in tabular.database_sections(spark, str(tmp_path / "o.json")).collect()}
    assert set(made) == {"log", "about"} and made["about"]["content_type"] == "prose"
    (tmp_path / "list.json").write_text(json.dumps([{"exercise": "Row", "sets": 2}]))
    assert tabular.database_sections(spark, str(tmp_path / "list.json")).first()["title"] == "Training Log Entry"
    with pytest.raises(ValueError):
        tabular.database_sections(spark, "a.xyz")


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"instruction": "q", "response": "a"}\n\nnot json\n{"instruction": "r"}\n')
    good, bad = records.read_tolerant(spark, str(tmp_path / "a.jsonl"), records.RECORDS["qa"])
    assert good.count() == 2 and bad.count() == 1


def test_steps_end_to_end(spark, tmp_path):
    base = str(tmp_path)
    sentences = " ".join(f"Sentence number {i} talks about load and rest in the gym." for i in range(40))
    (tmp_path / "p.html").write_text(f"<html><title>P</title><body><article>{sentences}</article></body></html>")
    (tmp_path / "log.csv").write_text("date,exercise,sets\n2024-01-15,Squat,4\n2024-01-17,Row,3\n")
    (tmp_path / "registry.yaml").write_text("sources:\n- {id: page, type: html, path: p.html}\n- {id: log, type: csv, path: log.csv}\n- {id: gone, type: html, path: no.html}\n")
    steps.run_steps(spark, base, ["extract", "chunk", "generate", "validate", "prepare", "unknown"], Settings())
    assert {p.name for p in (tmp_path / "extracted").iterdir() if p.is_dir()} == {"folder=articles", "folder=training_logs"}
    final = spark.read.json(f"{base}/final")
    assert final.count() > 0 and set(final.columns) >= {"text", "format", "source_id", "split"}
    before = spark.read.json(f"{base}/generated/qa").count()
    steps.generate_all(spark, base, Settings(), resume=True)
    assert spark.read.json(f"{base}/generated/qa").count() == before
    steps.main(["--list-steps"])


def test_stream_validation(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    answer = "a long enough answer that has more than ten words in all of it"

    def arrive(name, *questions):
        (tmp_path / "in" / name).write_text("\n".join([json.dumps({"instruction": q, "response": answer}) for q in questions] + ["broken"]))

    def run():
        stream = incremental.stream_records(spark, source, records.RECORDS["qa"])
        incremental.start_validation(stream, "qa", out, state).awaitTermination()
        return sorted(r["instruction"] for r in spark.read.parquet(out).collect())

    arrive("1.jsonl", "What is a squat exercise?", "What is a squat exercise!", "no")
    assert run() == ["What is a squat exercise?"]
    arrive("2.jsonl", "What is a squat exercises?", "How many sets should be done?")
    assert run() == ["How many sets should be done?", "What is a squat exercise?"]


def write_styled(path, epoch_1904=False):
    """A workbook whose first column is styled as a date, one cell by a built-in format and one by its own."""
    write_xlsx(path, {"Log": [["date", "exercise", "sets"], [45296, "Squat", 4], [45297.5, "Row", 3], [0.75, "Plank", 2]]})
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    sheet = parts["xl/worksheets/s0.xml"]
    for ref, style in (("A2", 1), ("A3", 2), ("A4", 2)):
        sheet = sheet.replace(f'<c r="{ref}">', f'<c r="{ref}" s="{style}">')
    parts["xl/worksheets/s0.xml"] = sheet
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts["xl/styles.xml"] = f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd&quot; at &quot;hh:mm"/><numFmt numFmtId="165" formatCode="&quot;days&quot; 0.0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    if epoch_1904:
        parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
    with zipfile.ZipFile(path, "w") as z:
        for n, text in parts.items():
            z.writestr(n, text)


def test_workbook_dates(spark, tmp_path):
    write_styled(tmp_path / "d.xlsx")
    rows = tabular.xlsx_sheets(str(tmp_path / "d.xlsx"))["Log"]
    assert [r[0] for r in rows] == ["date", "2024-01-05", "2024-01-06 12:00:00", "18:00:00"]
    got = tabular.spreadsheet_sections(spark, str(tmp_path / "d.xlsx")).orderBy("section_order").collect()
    assert [r["title"] for r in got][1] == "Training Session - January 05, 2024"
    write_styled(tmp_path / "m.xlsx", epoch_1904=True)
    assert tabular.xlsx_sheets(str(tmp_path / "m.xlsx"))["Log"][1][0] == "2028-01-06"
    assert tabular.date_text(1, False) == "1900-01-01" and tabular.date_text(61, False) == "1900-03-01"
    assert not tabular.is_date_format('"days" 0.0') and not tabular.is_date_format("General") and tabular.is_date_format("[h]:mm") is True


def test_old_workbooks_need_a_reader(spark, tmp_path):
    (tmp_path / "o.xls").write_bytes(b"old")
    with pytest.raises(ValueError):
        tabular.spreadsheet_sections(spark, str(tmp_path / "o.xls"))
    got = tabular.spreadsheet_sections(spark, str(tmp_path / "o.xls"), None, lambda path: {"S": [["exercise", "sets"], ["Squat", 3]]})
    assert [(r["part"], r["text"]) for r in got.collect()] == [("S", "The client performed 3 sets of Squat.")]


def test_quoted_lines_of_delimited_files(spark, tmp_path):
    (tmp_path / "q.csv").write_text('exercise,notes\nSquat,"two\nlines"\nRow,"a ""b"""\n')
    assert tabular.read_delimited(spark, str(tmp_path / "q.csv")).count() == 2
    (tmp_path / "p.csv").write_text("exercise,notes\nSquat,one\nRow,two\n")
    assert tabular.read_delimited(spark, str(tmp_path / "p.csv")).count() == 2


def pages_of(data):
    return [f"CHAPTER ONE\n{WORDS}"]


def read_image(data):
    return WORDS


def test_engines_and_warnings(spark, tmp_path, caplog):
    (tmp_path / "b.pdf").write_bytes(b"x")
    (tmp_path / "i.png").write_bytes(b"x")
    (tmp_path / "registry.yaml").write_text("sources:\n- {id: book, type: pdf, path: b.pdf}\n- {id: scan, type: image_ocr, path: i.png}\n")
    assert steps.extract(spark, str(tmp_path)) is None
    assert {r.getMessage().split(":")[0] for r in caplog.records} >= {"book", "scan"}
    engines = steps.Engines.named([f"pdf={__name__}:pages_of", f"ocr={__name__}:read_image"])
    got = steps.extract(spark, str(tmp_path), engines=engines).collect()
    assert {(r["source_id"], r["title"], r["folder"], r["section_pos"]) for r in got} == {("book", "CHAPTER ONE", "textbooks", 0), ("scan", "i", "training_logs", 0)}
    for bad in ("pdf=nothing", "doc=a:b", "pdf=os:none"):
        with pytest.raises(ValueError):
            steps.Engines.named([bad])


def test_split_ratios_are_read(tmp_path):
    (tmp_path / "c.yaml").write_text("data: {train_val_test_split: [0.7, 0.2, 0.1]}\n")
    assert Settings.load(str(tmp_path / "c.yaml")).split == (0.7, 0.2)
    (tmp_path / "c.yaml").write_text("data: {train_val_test_split: [0.9, 0.2]}\n")
    with pytest.raises(ValueError):
        Settings.load(str(tmp_path / "c.yaml"))


def test_main_text_of_plain_pages(spark):
    from pyspark.sql import functions as F

    page = f"<body><div class=top><a href=x>one</a> <a href=y>two</a></div><div><h2>Head</h2><p>{WORDS}<br>{WORDS}</p><table><tr><td>cell one</td><td>cell two</td></tr></table></div><div class='comments'><p>{WORDS * 4}</p></div></body>"
    row = markup.html_sections(spark.createDataFrame([(page,)], "html string"), "html", F.lit("n")).first()
    assert row["extraction_method"] == "main_text" and row["text"] == f"Head\n{WORDS}\n{WORDS}\ncell one\ncell two"
    plain = markup.html_sections(spark.createDataFrame([(page,)], "html string"), "html", F.lit("n"), main=False).first()
    assert plain["extraction_method"] == "fallback" and "one" in plain["text"]
