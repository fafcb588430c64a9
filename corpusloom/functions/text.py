"""Text functions as Column builders. Everything but Unicode normalisation is a built-in expression."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as code points that Java and RE2 patterns read alike.
SPACES = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{SPACES}]"
NOT_WS = f"[^{SPACES}]"
#: The same characters one by one.
SPACE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: The rest of a word and the white space after it; the first range holds most characters and is tried first.
REST = rf"(?:[!-~\x{{A1}}-\x{{167F}}]++|{NOT_WS})*+{WS}*+"
#: A word with its first letter, or a word without letters with its first character. Never reads a character more than twice.
MARKED_WORD = rf"[^{SPACES}\p{{L}}]*+(\p{{L}}){REST}|({NOT_WS}){REST}"
PAGE_NUMBER = rf"^{WS}*\p{{Nd}}+{WS}*$"
CHAPTER_LINE = rf"^{WS}*(Chapter|CHAPTER){WS}+\p{{Nd}}+{WS}*$"
REFERENCES = rf"\n(References|REFERENCES|Bibliography|BIBLIOGRAPHY){WS}*\n[\s\S]*\z"
WORKS_CITED = rf"\n(Works Cited|WORKS CITED){WS}*\n[\s\S]*\z"
#: Offline token estimate: runs of word characters, and every other mark by itself.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x{09}-\x{0D} ]"
#: Typographic marks and their plain forms; fixed values.
PLAIN = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", " ": " ", "​": ""}


def strip(text: Column) -> Column:
    """Python's str.strip(); looks at the ends only."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def word_count(text: Column) -> Column:
    """len(str.split()). Words are replaced by one character each, as `regexp_count` keeps a list of them all."""
    return F.octet_length(F.regexp_replace(strip(text), f"{NOT_WS}{REST}", "x"))


def has_words(text: Column, least: int) -> Column:
    """word_count(text) >= least, from one on, read up to that word."""
    return text.rlike(rf"\A{WS}*+(?:{NOT_WS}++{WS}++){{{least - 1}}}{NOT_WS}")


def _nfkd(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Some texts at a time, so that a batch isn't held as Python strings."""
    for texts in batches:
        parts = []
        for lo in range(0, max(1, len(texts)), 64):
            parts.append(pa.array([None if t is None else unicodedata.normalize("NFKD", t) for t in texts.slice(lo, 64).to_pylist()], pa.string()))
        yield pa.concat_arrays(parts)


def normalize_unicode(text: Column) -> Column:
    """NFKD, then plain quotes, dashes, dots and spaces. Rows in plain ASCII are left alone by definition."""
    ascii = F.octet_length(text) == F.length(text)
    out = F.arrow_udf(_nfkd, "string")(F.when(~ascii, text))  # Python gets a null in place of plain ASCII
    for mark, plain in PLAIN.items():
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return F.when(ascii, text).otherwise(out)


def clean_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, "[ \\t]+", " "), "\\n{3,}", "\n\n"))


def remove_page_artifacts(text: Column) -> Column:
    """Blank out lines that hold only a page number or a chapter label; `(?d)` lets only a line feed end a line."""
    return F.regexp_replace(F.regexp_replace(text, f"(?md){PAGE_NUMBER}", ""), f"(?md){CHAPTER_LINE}", "")


def remove_references_section(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, REFERENCES, ""), WORKS_CITED, "")


def clean_html_residue(text: Column) -> Column:
    out = F.regexp_replace(text, "<[^>]+>", "")
    return F.regexp_replace(F.regexp_replace(out, "&[a-zA-Z]+;", " "), r"&#\p{Nd}+;", " ")


def full_clean(text: Column, remove_references: bool = False, unicode: bool = True) -> Column:
    out = normalize_unicode(text) if unicode else text
    out = remove_page_artifacts(clean_html_residue(out))
    return clean_whitespace(remove_references_section(out) if remove_references else out)


def marked_words(text: Column) -> Column:
    """A character for each word: a letter of a word that holds one, else its first character."""
    return F.regexp_replace(strip(text), MARKED_WORD, "$1$2")


def meaningful_marks(marks: Column, min_words: int = 10) -> Column:
    """`is_meaningful` of the text whose `marked_words` these are."""
    return F.coalesce((F.length(marks) >= min_words) & (2 * F.length(F.regexp_replace(marks, r"\P{L}++", "")) > F.length(marks)), F.lit(False))


def is_meaningful(text: Column, min_words: int = 10) -> Column:
    """At least `min_words` words, over half of which hold a letter."""
    # the lambda binds the marks, so that a filter makes them once
    return F.get(F.transform(F.array(marked_words(text)), lambda m: meaningful_marks(m, min_words)), F.lit(0))


def sentences(text: Column) -> Column:
    """Split after a full stop, exclamation or question mark and white space; a trailing empty part stays."""
    return F.split(text, f"(?<=[.!?]){WS}+")


def token_count(text: Column) -> Column:
    """The offline estimate of a text's tokens; see `bpe_counter` for exact counts."""
    return F.regexp_count(text, F.lit(TOKEN))


def bpe_counter(path: str):
    """Exact counts by a tokenizer file: an Arrow UDF text -> int."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for texts in batches:
            yield pd.Series([len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)], dtype="int32")

    return F.pandas_udf(run, "int")


def char_token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def chunk_id(source_id: Column, index: Column) -> Column:
    return F.format_string("%s_chunk_%04d", source_id, index)


def preview(text: Column, n: int = 100, ellipsis: str = "") -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(ellipsis))).otherwise(text)
