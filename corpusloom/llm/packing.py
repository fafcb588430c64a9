"""Packing token sequences by first-fit decreasing over a tournament tree, in randomised groups of pieces.

Each text is encoded whole, its end id appended, and cut every `size` ids. Pieces of exactly `size` ids fill a
sequence of their own; the others are dealt to random groups of about `group_size` pieces, and each group is packed
by itself: longest piece first, each into the first bin with room, which a tournament tree of bin capacities finds in
log time. A group leaves at most its last few bins part empty.

Defined results: a null text counts as empty and yields the end id alone; repeated rows are packed once each; very
long texts spread over several sequences; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, text_slices
from corpusloom.session import ship

#: The tokenizer's own splitting pattern on lower-case printable ASCII; a fixed value of its file.
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: First bytes of U+0300 to U+037F, which hold all marks that ASCII letters compose with.
MARKS = (b"\xcc", b"\xcd")
PUNCTUATION = frozenset(string.punctuation.encode())


class ChunkEncoder(dict):
    """Chunk of UTF-8 between ASCII white space -> bytes of its ids, for a BPE tokenizer that splits at white space and
    drops it.

    A chunk's ids don't depend on its neighbours, so each distinct chunk is split into words and merged once. A letter
    and the punctuation after it are never in one word, so a last sign is looked up by itself and chunks with one take
    no room. The table is kept in two generations: when the young one is full it becomes the old one, so frequent
    entries stay and memory is bounded.

    The tokenizer lower-cases, so texts are looked up with A-Z lower-cased; not those that hold a special token, in any
    case, or a mark: some marks compose with a small letter only (j and caron), and composing comes before lower-casing.
    """

    def __init__(self, path: str, room: int = 240_000, longest: int = 80):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.normalize, self.split = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.room, self.longest, self.old = room, longest, {}

    def whole(self, chunk: bytes) -> bytes:
        return array("I", self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.merge(word)]).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(chunk) > self.longest:
            return self.whole(chunk)
        value = self.old.get(chunk)
        if value is None:
            if chunk.isalpha():  # A-Z, a-z
                value = self.word(chunk.decode().lower())
            elif chunk[-1] in PUNCTUATION and chunk[-2:-1].isalnum():
                return self[chunk[:-1]] + self[chunk[-1:]]
            else:
                text = chunk.decode()
                if text.isascii() and text.isprintable():
                    parts = ASCII_WORD.findall(text.lower())
                else:
                    parts = [p for p, _ in self.split(self.normalize(text))]
                value = b"".join([self[p.encode()] if p.isascii() and p.isalpha() else self.word(p) for p in parts])
        if len(self) >= self.room:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[chunk] = value
        return value

    def ids_of(self, raw: bytes) -> bytes:
        """The ids of a text in UTF-8."""
        low = raw.lower()  # A-Z only
        if any([s in low for s in self.specials]):
            return b"".join([self.whole(c) if any(s in c for s in self.specials) else self[c] for c in raw.split()])
        return b"".join(map(self.__getitem__, (raw if any([m in low for m in MARKS]) else low).split()))

    def ids(self, text: str) -> bytes:
        return self.ids_of(text.encode())


#: Encoders of this Python worker, by path: a worker runs many tasks, and what it has learned stays.
ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in ENCODERS:
        ENCODERS[path] = ChunkEncoder(path)
    return ENCODERS[path]


PIECE = pa.schema([(c, pa.int64()) for c in ("id", "start", "length", "ids_crc32", "doc_tokens", "r")])


def pieces(path: str, size: int, end_id: int):
    """(id, UTF-8 text) batches -> (id, start, length, ids_crc32, doc_tokens, r) rows; r orders and deals the pieces."""
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids, row = encoder(path).ids_of, 0
        for batch in batches:
            for keys, texts in zip(text_slices(batch.column(0)), text_slices(batch.column(1)), strict=True):
                out: list[tuple] = []
                for key, text in zip(keys, texts, strict=True):
                    raw = (ids(text) if text is not None else b"") + tail
                    total, view, row = len(raw) // 4, memoryview(raw), row + 1
                    for start in range(0, total, size):
                        length = min(size, total - start)
                        crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                        out.append((key, start, length, crc, total, zlib.crc32(b"%d %d %d %d" % (crc, start, total, row))))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 6)], schema=PIECE)

    return run


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length. The tree's leaves hold the room left in each bin, inner nodes the larger child."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [size] * (2 * leaves)
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, at = int(lengths[i]), 1
        while at < leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        bins[i], offsets[i] = at - leaves, size - tree[at]
        tree[at] -= need
        at //= 2
        while at:
            best = tree[2 * at] if tree[2 * at] >= tree[2 * at + 1] else tree[2 * at + 1]
            if tree[at] == best:
                break
            tree[at] = best
            at //= 2
    return bins, offsets


def pack_group(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["r", "start", "length", "ids_crc32"], kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), size)
        return pdf.assign(sequence_id=pdf["g"].to_numpy() * (1 << 32) + bins, offset=offsets)[["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1, group_size: int = 4096) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset in the sequence."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    cutting = cut(base.mapInArrow(pieces(tokenizer_path, size, end_id), "id long, start long, length long, ids_crc32 long, doc_tokens long, r long"))
    groups = max(1, -(-cutting.filter(F.col("length") < size).count() // group_size))
    part = cutting.filter(F.col("length") < size).withColumn("g", F.pmod(F.xxhash64("r", "start", "ids_crc32"), F.lit(groups)))
    packed = part.groupBy("g").applyInPandas(pack_group(size), "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    # whole sequences take ids after those of the groups, unique by the row's place in the checkpointed table
    whole = cutting.filter(F.col("length") == size).select("id", "start", "length", "ids_crc32", "doc_tokens", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole).withColumnRenamed("id", id_col)
