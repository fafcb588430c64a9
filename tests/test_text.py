import random
import time
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import similarity, text


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("‘a’ “b” – — … c​d", "'a' \"b\" - -- ... cd"),
        ("plain", "plain"),
        ("ﬁne", "fine"),
        ("é", "é"),
        ("a b", "a b"),
        (None, None),
    ],
)
def test_normalize_unicode(one, raw, expected):
    assert one(text.normalize_unicode, raw) == expected


def test_whitespace(one):
    assert one(text.clean_whitespace, " \t a  \t b\n\n\n\nc 　") == "a b\n\nc"


def test_page_artifacts(one):
    out = one(text.remove_page_artifacts, "start\n 42 \nwe saw 42 birds\nCHAPTER 12\nend")
    assert "we saw 42 birds" in out and "CHAPTER" not in out and "\n 42 " not in out


def test_references(one):
    assert one(text.remove_references_section, "body\nReferences\n[1]\nBibliography\n[2]") == "body"
    assert one(text.remove_references_section, "body References here") == "body References here"


def test_html_residue(one):
    assert one(text.clean_html_residue, "a<br>b &amp; c &#169; d &frac12;") == "ab   c   d &frac12;"


def test_full_clean_order(one):
    assert one(text.full_clean, "<p>“Hi”</p>\n\n\n\n12\n  there &nbsp; ") == '"Hi"\n\n there'


@pytest.mark.parametrize("raw, words, good", [("one two three four five six seven eight nine ten", 10, True), ("1 2 3 4 5 a b c d e", 10, False), ("1 2 3 4 a b c d e f", 10, True), ("few words", 2, False), ("", 0, False), (None, None, False)])
def test_meaningful(one, raw, words, good):
    assert one(text.word_count, raw) == words
    assert one(text.is_meaningful, raw) is good


def test_word_count_follows_python(one):
    rng = random.Random(3)
    for _ in range(20):
        raw = "".join(rng.choice(["a", "é", " ", "　", "\n", "\x1c", "\x85", "1", "​"]) for _ in range(30))
        assert one(text.word_count, raw) == len(raw.split())
        assert one(text.strip, raw) == raw.strip()


def test_sentences(one):
    assert one(text.sentences, "A b. C d!  E? ") == ["A b.", "C d!", "E?", ""]


def test_small_functions(one):
    assert one(text.token_count, "") == 0
    assert one(text.token_count, "Hi, you_2!") == 4
    assert one(text.char_token_estimate, "123456789") == 2
    assert one(lambda c: text.chunk_id(c, F.lit(7)), "s") == "s_chunk_0007"
    assert one(lambda c: text.chunk_id(c, F.lit(12345)), "s") == "s_chunk_12345"
    assert one(lambda c: text.preview(c, 3, "..."), "abcd") == "abc..."


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return row[-1]


def test_indel_ratio(one):
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 25))) for _ in range(2))
        assert similarity.lcs_length(a, b) == slow_lcs(a, b)
    assert one(similarity.indel_ratio, "", "") == 100.0
    assert one(similarity.indel_ratio, "abcd", "abed") == 75.0
    assert unicodedata.normalize("NFKD", "é") == "é"


def test_words_are_counted_in_one_pass(one):
    """A word of 200,000 digits was read from each of its characters on to look for a letter."""
    start = time.monotonic()
    assert one(lambda t: text.is_meaningful(t, 3), "7" * 200_000 + " a b c d") is True
    assert one(lambda t: text.is_meaningful(t, 3), "a " + "7" * 200_000 + " 8 b") is False
    assert one(text.word_count, "\u00e9" * 200_000 + " \U0001f600") == 2
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("least", [1, 2, 10])
def test_has_words_follows_word_count(one, least):
    for raw in ("", "  ", "a", "\x1ca\x85", " a  b ", "a b c d e f g h i", "a b c d e f g h i j", "x " * 500):
        assert one(lambda t: text.has_words(t, least), raw) == (len(raw.split()) >= least)


def test_normalisation_holds_few_texts_at_once():
    """The whole batch was held as Python strings, twice."""
    batch = pa.array(["é" * 20_000] * 2_000)
    tracemalloc.start()
    (out,) = text._nfkd(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 2_000 and out[0].as_py() == "é" * 20_000 and peak < 20_000_000
    assert text._nfkd(iter([pa.array([None, "ﬁ"])])).__next__().to_pylist() == [None, "fi"]
