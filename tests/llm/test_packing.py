import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string"


def plain_first_fit(lengths, size):
    bins, where = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, room in enumerate(bins) if room >= lengths[i]), None)
        if at is None:
            at = len(bins)
            bins.append(size)
        where[i] = (at, size - bins[at])
        bins[at] -= lengths[i]
    return where


def test_tree_is_first_fit_decreasing():
    rng = random.Random(2)
    for n in (1, 2, 3, 17, 200):
        lengths = [rng.randint(1, 100) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(np.array(lengths), 100)
        assert {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets))} == plain_first_fit(lengths, 100)


def test_chunks_encode_as_the_tokenizer_does():
    rng = random.Random(3)
    parts = ["a", "B", "'s", "'", "é", "e\u0301", "ß", "Σ", "İ", "1", "½", " ", "\n", "\x1c", "\x85", "\u3000", "\u200b", "<|endoftext|>", "<|", "!", "漢字", "😀", "\x00", "ﬁ", "'LL", "don't", "\u0301"]
    full, own = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH, room=50)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.ids(text) == np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_lower_case_and_last_signs_encode_as_the_tokenizer_does():
    rng = random.Random(4)
    parts = ["J", "j", "T", "K", "\u030c", "\u0308", "\u0307", "\u0344", "\u212a", "İ", "Σ", "É", "ß", "»", "…", "½", "²", "7", ",", ".", ")", "'", "'S", "<", ">", "=", "\u0338", " ", "\t", "\x0b", "\x0c", "\xa0", "\u2028", "<|ENDOFTEXT|>", "<|endoftext|>", "the", "The", "한", "\u1112\u1161"]
    full, own = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH, room=50)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.ids(text) == np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    for text in ("x" * 500 + ",", "<|startoftext|>," * 20, "漢字" * 50):
        assert own.ids(text) == np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_forms_of_a_word_share_an_entry():
    own, merged = packing.ChunkEncoder(PATH, room=70), collections.Counter()
    plain = own.merge
    own.merge = lambda word: merged.update([word]) or plain(word)
    words = [a + b for a in ("mal", "tor", "ves", "nic", "gar", "lum") for b in ("ane", "ost", "ith", "ule", "ern", "ock", "iva", "ash", "ume", "ond")]
    for form in ("{}", "{},", "{}.", "{}!") * 3:
        own.ids(" ".join(form.format(w.title() if i % 2 else w) for i, w in enumerate(words)))
    assert merged == {w: 1 for w in (*words, ",", ".", "!")}
    assert len(own) == len(merged) and not own.old


def test_pack(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "été", "don't"]
    data = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 50, 400, 5000])))) for i in range(150)]
    data += [(1000, None), (1001, ""), (1002, "x" * 20000), (None, "no id"), *[(5, "same row")] * 40]
    got = packing.pack(spark.createDataFrame(data, DOCS), PATH, group_size=64).collect()
    full = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for key, text in data:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            want[key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= total / 2048 + 4 + len(got) / 64


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
    clash = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, start int, g int")
    assert packing.pack(clash, PATH).count() == 1
