"""HTML pages and EPUB books to cleaned text.

The main text of a page is that of the element whose own paragraphs, list items, table cells and headings hold the most
text that isn't links, within articles and main where there are any, without reader comments. Where that isn't meaningful, the text is what lies in its first article,
else main, else body. Both leave out scripts, styles, menus, headers, footers and sidebars. Parsing is an Arrow UDF over
the standard library's tolerant parser; cleaning is built-in.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import full_clean, is_meaningful
from corpusloom.operators.sections import split_by_headings
from corpusloom.session import ship

DROPPED = frozenset(["script", "style", "nav", "footer", "header", "aside"])
#: Names of class or id attributes that hold reader comments.
COMMENT_NAMES = frozenset(["comment", "comments", "comment-list", "commentlist", "disqus_thread", "respond"])
BLOCKS = frozenset(["p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "dt", "figcaption", "caption"])
INLINE = frozenset(["a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])


class TextParser(HTMLParser):
    """Collects strings outside dropped elements: of the title, and of the first article, main and body."""

    def __init__(self, dropped: frozenset[str] = DROPPED, headings: tuple[str, ...] = ()):
        super().__init__(convert_charrefs=True)
        self.dropped, self.stack = dropped, []
        self.parts: dict[str, list[str]] = {k: [] for k in ("title", "article", "main", "body", "all", *headings)}
        self.state: dict[str, int] = {}  # depth of the stack at which a first element opened; -1: it is over

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in VOID:
            return
        self.stack.append(tag)
        if tag in self.parts and tag not in self.state and not self.hidden():
            self.state[tag] = len(self.stack)

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.stack:
            return
        while True:
            top = self.stack.pop()
            for name, depth in self.state.items():
                if depth > len(self.stack):
                    self.state[name] = -1
            if top == tag:
                return

    def hidden(self) -> bool:
        return not self.dropped.isdisjoint(self.stack)

    def handle_data(self, data: str) -> None:
        if self.hidden():
            return
        self.parts["all"].append(data)
        for name, depth in self.state.items():
            if depth > 0:
                self.parts[name].append(data)

    def main(self) -> str | None:
        for name in ("article", "main", "body"):
            if name in self.state:
                return "\n".join(self.parts[name])
        return None


class ArticleParser(HTMLParser):
    """Collects text by blocks, each with the elements around it and the characters that lie in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # tag, number of the element, whether it and what it holds are left out
        self.made = 0
        self.blocks: list[tuple[tuple[int, ...], str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0

    def close_block(self) -> None:
        text = "".join(self.parts).strip()
        if text:
            around = [n for tag, n, _ in self.stack if tag not in BLOCKS and tag not in INLINE]
            self.blocks.append((tuple(around), text, self.linked, any(t in ("article", "main") for t, _, _ in self.stack)))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        if tag not in INLINE:
            self.close_block()
            if tag in BLOCKS:  # a block ends an open one of its kind, as browsers read it
                while self.stack and (self.stack[-1][0] in INLINE or self.stack[-1][0] == tag):
                    self.stack.pop()
        names = {w for k, v in attrs if k in ("class", "id") and v for w in v.lower().split()}
        left_out = bool(self.stack and self.stack[-1][2]) or tag in DROPPED or tag in ("title", "head", "template", "noscript") or not COMMENT_NAMES.isdisjoint(names)
        self.made += 1
        self.stack.append((tag, self.made, left_out))

    def handle_endtag(self, tag: str) -> None:
        if all(t != tag for t, _, _ in self.stack):
            return
        if tag not in INLINE:
            self.close_block()
        while self.stack.pop()[0] != tag:
            pass

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][2]:
            return
        self.parts.append(data)
        if any(t == "a" for t, _, _ in self.stack):
            self.linked += len(data.strip())

    def main(self) -> str:
        """The blocks within the element whose own blocks hold the most text; half of it counts for the element around.
        Where some lie in an article or main, only these are considered."""
        self.close_block()
        score: dict[int, float] = {}
        blocks = [b for b in self.blocks if b[3]] or self.blocks
        for around, text, linked, _ in blocks:
            for place, weight in zip(reversed(around), (1.0, 0.5), strict=False):
                score[place] = score.get(place, 0.0) + weight * max(0, len(text) - 2 * linked)
        if not score:
            return ""
        best = min(score, key=lambda n: (-score[n], n))
        return "\n".join(text for around, text, _, _ in blocks if best in around)


def article_text(html: str) -> str:
    parser = ArticleParser()
    parser.feed(html)
    parser.close()
    return parser.main()


def parse_page(html: str | None) -> tuple[str, str | None, str]:
    parser = TextParser()
    parser.feed(html or "")
    parser.close()
    return "".join(x.strip() for x in parser.parts["title"]), parser.main(), article_text(html or "")


PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("raw", T.StringType()), T.StructField("article", T.StringType())])


def page_text(html: Column) -> Column:
    """struct(title, raw, article): raw is null where the page has no body. Pages are parsed some at a time, so that a
    batch of long ones isn't held as Python strings."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            parts = []
            for lo in range(0, max(1, len(pages)), 64):
                found = [parse_page(p) for p in pages.slice(lo, 64).to_pylist()]
                parts.append(pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(3)], names=["title", "raw", "article"]))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(run, PAGE)(html)


def html_sections(pages: DataFrame, html_col: str, name: Column, unicode: bool = True, main: bool = True) -> DataFrame:
    """`pages` with title, text and extraction_method; pages without meaningful text are left out.

    `main` False takes the first article, main or body at once.
    """
    ship(pages.sparkSession)
    made = pages.withColumn("__p", page_text(F.col(html_col)))
    article = full_clean(F.col("__p")["article"], unicode=unicode)
    whole = full_clean(F.coalesce(F.col("__p")["raw"], F.lit("")), unicode=unicode)
    made = made.withColumns({"title": F.coalesce(F.nullif(F.col("__p")["title"], F.lit("")), name), "__a": article if main else F.lit("")})
    made = made.withColumn("extraction_method", F.when(is_meaningful(F.col("__a")), "main_text").otherwise("fallback"))
    made = made.withColumn("text", F.when(F.col("extraction_method") == "main_text", F.col("__a")).otherwise(whole))
    return made.filter(is_meaningful(F.col("text"))).drop("__p", "__a")


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """source_file, title, text and content_type of HTML files; bytes that aren't UTF-8 become replacement marks."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return html_sections(files, "html", stem).select(F.col("path").alias("source_file"), "title", "text", F.lit("prose").alias("content_type"))


BOOK_ITEM = "source_file string, item_pos int, name string, heading string, raw string"


def book_items(data: bytes) -> list[tuple[str, str, str]]:
    """(name, first heading, text) of each document of an EPUB, in manifest order."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        opf = next(e.attrib["full-path"] for e in container.iter() if e.tag.endswith("rootfile"))
        root = ElementTree.fromstring(book.read(opf))
        for item in (e for e in root.iter() if e.tag.endswith("}item")):
            if item.attrib.get("media-type") != "application/xhtml+xml":
                continue
            name = posixpath.normpath(posixpath.join(posixpath.dirname(opf), item.attrib["href"]))
            parser = TextParser(frozenset(), ("h1", "h2", "h3"))
            parser.feed(book.read(name).decode("utf-8", "replace"))
            parser.close()
            heading = next((h for k in ("h1", "h2", "h3") if k in parser.state and (h := "".join(x.strip() for x in parser.parts[k]))), "")
            out.append((item.attrib["href"], heading, "\n".join(parser.parts["all"])))
    return out


def read_epub(spark: SparkSession, path: str, long_text: int = 5000) -> DataFrame:
    """Sections of EPUB books: long items are split at headings if that gives more than one section."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, i, *item) for p, data in zip(pdf["path"], pdf["content"], strict=True) for i, item in enumerate(book_items(bytes(data)))]
            yield pd.DataFrame(rows, columns=["source_file", "item_pos", "name", "heading", "raw"])

    items = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, BOOK_ITEM)
    items = items.withColumn("text", full_clean(F.col("raw"))).filter(is_meaningful(F.col("text"))).drop("raw")
    parts = split_by_headings(items.filter(F.length("text") > long_text))
    parts = parts.groupBy("source_file", "item_pos").agg(F.array_sort(F.collect_list(F.struct("section_pos", F.col("title"), F.col("section_text").alias("text")))).alias("parts")).filter(F.size("parts") > 1)
    whole = F.array(F.struct(F.lit(0).alias("section_pos"), F.coalesce(F.nullif("heading", F.lit("")), F.col("name")).alias("title"), F.col("text")))
    made = items.join(parts, ["source_file", "item_pos"], "left").withColumn("s", F.explode(F.coalesce("parts", whole)))
    return made.select("source_file", "item_pos", F.col("name"), F.col("s.section_pos").alias("section_pos"), F.col("s.title").alias("title"), F.col("s.text").alias("text"), F.lit("prose").alias("content_type"))
