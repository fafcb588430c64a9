"""Near-duplicate classes by Order MinHash (OMH) with verification by banded alignment.

Texts are lower-cased word sequences; the k-mers are three-word shingles, each labelled with its occurrence number, so
that repeats count. One sample hashes all labelled shingles with its own seed, takes the `per_sample` smallest and
keeps them in text order; texts that agree in one sample become candidates. Order matters, so the sketch follows edit
similarity and not only the overlap of sets. A candidate pair is a link when the longest common word subsequence
inside the band that the threshold allows covers `threshold` of the longer text.

Equal word sequences collapse first, so copies cost one node. In each bucket the members are compared with central ones
first, which joins near copies into classes; then only pairs of different classes are left. Those of a bucket of up to
`large` members are tried against a bound on the words that they can share: first the most promising of each class,
then all that are left. A larger bucket is split by words: an alignment over the threshold leaves few words out, so both
texts have one of their rarest words in common (the prefix filter), and only members that share such a word meet. Both
rules leave out no pair that the alignment would accept, so every link between texts that agree in a sample is found,
or its two texts are in one class already.

Defined results: a text without words (null counts as empty) is near only to the same raw text; a text of one to
three words is one shingle; very long texts are read whole; the class id is the smallest doc_id of the class (null only
if all are null); rows that repeat a doc_id each get their row; an empty table gives an empty result; `classes` reads
the id and the text only, and `dedup` returns the input's columns, whatever they are called.

Node ids are 64-bit hashes of the word sequence: n distinct texts meet by chance with odds of about n^2 / 2^65.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import MOST_KEYS, MOST_SENT, ChunkCache, cut, join_unique, temp, text_slices
from corpusloom.session import ship

SHINGLE = 3
#: Members of a group up to which its pairs are tried by a join, and up to which one task tries them.
SMALL, LARGE = 16, 4096
#: Pairs that each class of a group contributes to the first round; then come all that are left.
PROMISING = 8
#: Centres of a larger group in the first round that has several.
FIRST_CENTRES = 8
#: Longs of 64 word parities that a text's bound takes, in joins and within a task.
PARITIES, FINE = 8, 32
#: Bins of the sketch of word frequencies, the most that the driver gets of it.
BINS = 1 << 18
WORD = re.compile(r"\w+")
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _chunk_words(chunk: str) -> bytes:
    return b"".join(xxhash.xxh64_digest(w.encode("utf-8", "surrogatepass"))[::-1] for w in WORD.findall(chunk.lower()))


def word_hashes(text: str, cache: dict) -> np.ndarray:
    """A 64-bit hash for each word. Words never span white space, so chunks are looked up whole."""
    return np.frombuffer(b"".join(map(cache.__getitem__, text.split())), dtype="<u8")


def labelled_shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles with their occurrence number, in text order."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        out = mix(out * STEP + words[j : n - width + 1 + j])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    start = np.r_[True, ranked[1:] != ranked[:-1]]
    if not start.all():
        at = np.arange(len(out))
        label = np.empty(len(out), dtype=np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(start, at, 0))).astype(np.uint64)
        out = np.where(label == 0, out, mix(out + label * MIX_A))  # a first occurrence keeps its hash
    return out


def order_minhash(words: np.ndarray, samples: np.ndarray, smallest: int, block: int = 1 << 18) -> np.ndarray:
    """One hash per sample number: its `smallest` smallest labelled shingles, combined in text order."""
    shingles = labelled_shingles(words)
    n = len(shingles)
    take = min(smallest, n)
    seeds = mix((samples.astype(np.uint64) + np.uint64(1)) * STEP)
    out = np.empty(len(samples), dtype=np.uint64)
    rows = max(1, block // n)
    for at in range(0, len(samples), rows):
        seed = seeds[at : at + rows]
        hashed = (shingles[None, :] ^ seed[:, None]) * MIX_A
        hashed ^= hashed >> np.uint64(32)
        hashed *= MIX_B
        best = np.argpartition(hashed, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(seed), 1))
        best.sort(axis=1)
        acc = seed.copy()
        for j in range(take):
            acc = mix(acc * STEP + shingles[best[:, j]])
        out[at : at + rows] = acc
    return out


def node_of(text: str, words: np.ndarray) -> int:
    """The node of a text with these word hashes; one without words is near only to the same raw text."""
    return xxhash.xxh3_64_intdigest(words.tobytes() if len(words) else b"\0raw" + text.encode("utf-8", "surrogatepass"))


def sketch_rows(samples: int, per_sample: int):
    """(id, text) batches -> (id, node, sketch, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache(_chunk_words)
        for batch in batches:
            for ids, texts in zip(text_slices(batch.column(0)), text_slices(batch.column(1)), strict=True):
                node, sketch, ends, words = [], [], [0], []
                for text in texts:
                    text = text or ""
                    w = word_hashes(text, cache)
                    node.append(node_of(text, w))
                    if len(w):
                        sketch.append(order_minhash(w >> np.uint64(32), np.arange(samples), per_sample))
                    ends.append(ends[-1] + samples * bool(len(w)))
                    words.append((w >> np.uint64(32)).astype("<u4").tobytes())
                values = np.concatenate(sketch).view(np.int64) if sketch else np.empty(0, dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                columns = [pa.array(ids, pa.int64()), pa.array(np.array(node, dtype=np.uint64).view(np.int64)), lists, pa.array(words, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "sketch", "words"])

    return run


def banded_common(a: np.ndarray, b: np.ndarray, below: int, above: int, need: int = 0, step: int | None = None) -> int:
    """Length of the longest common subsequence whose matches a[i] = b[j] have -below <= i - j <= above.

    Bit-parallel: bit i of `state` is 0 where the length grows at a[i]. Only the window of the band is kept, cut loose
    every `step` words of b (as many as the band is wide). Once `need` can't be reached any more, what was found so far is returned.
    """
    n = min(len(a), len(b))
    differ = np.nonzero(a[:n] != b[:n])[0]
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.nonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])[0]
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    step = step or max(512, below + above + 1)
    settled, base, top, state = head + tail, 0, 0, 0
    width = (1 << (below + above + 1)) - 1
    for start in range(0, len(b), step):
        low, high = min(max(0, start - below), len(a)), max(0, min(len(a), start + step + above))
        if low >= top:  # the window has left what was there
            settled += (top - base) - state.bit_count()
            state, top = 0, low
        else:
            settled += (low - base) - (state & ((1 << (low - base)) - 1)).bit_count()
            state >>= low - base
        base = low
        if high > top:
            state |= ((1 << (high - top)) - 1) << (top - base)
            top = high
        if settled + (top - base) - state.bit_count() + len(b) - start < need:
            break
        at: dict[int, int] = {}
        for i, x in enumerate(a[base:top].tolist()):
            at[x] = at.get(x, 0) | (1 << i)
        full = (1 << (top - base)) - 1
        for j, x in enumerate(b[start : start + step].tolist(), start - below - base):
            hit = at.get(x)
            if hit:
                hit &= width << j if j >= 0 else width >> -j
                u = state & hit
                state = ((state + u) | (state - u)) & full
    return settled + (top - base) - state.bit_count()


def alike(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """True if an alignment within the band covers `threshold` of the longer word sequence."""
    need = math.ceil(threshold * max(len(a), len(b)) - 1e-9)
    if min(len(a), len(b)) < need:
        return False
    # an alignment that covers `need` leaves at most this many words of either side unmatched
    return banded_common(a, b, len(b) - need, len(a) - need, need) >= need


def parities(words: np.ndarray) -> np.ndarray:
    """FINE longs: by hash, bit by bit, whether an odd number of the labelled words falls there.

    Each word that only one of two texts has changes one bit, so the bits that differ are at most those words.
    """
    at = labelled_shingles(words, 1) >> np.uint64(40)
    odd = np.bincount((at % np.uint64(64 * FINE)).astype(np.int64), minlength=64 * FINE) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def folded(bits: np.ndarray) -> np.ndarray:
    """PARITIES longs out of the FINE ones of each row, with the same property."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), FINE // PARITIES, PARITIES), axis=1)


def bound_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, words) -> (node, bits, n, p0, ...): the parities, number of words and folded parities."""
    for batch in batches:
        words = [np.frombuffer(w, dtype="<u4").astype(np.uint64) for w in batch.column(1).to_pylist()]
        fine = np.array([parities(w) for w in words], dtype=np.int64).reshape(len(words), FINE)
        coarse = folded(fine)
        columns = [batch.column(0), pa.array([x.tobytes() for x in fine], pa.binary()), pa.array([len(w) for w in words], pa.int64()), *[pa.array(coarse[:, i]) for i in range(PARITIES)]]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "bits", *BOUNDS])


BOUNDS = ["n", *[f"p{i}" for i in range(PARITIES)]]


def may_be_alike(threshold: float) -> Column:
    """False only for pairs that no alignment covers to `threshold`: it leaves n + c_n - 2 * threshold * longer words
    unmatched at most, and every parity that differs needs one."""
    differ = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"c_p{i}"))) for i in range(PARITIES)), F.lit(0))
    return differ <= F.col("n") + F.col("c_n") - 2 * threshold * F.greatest("n", "c_n") + 1e-6


def first_agreed(sketch: np.ndarray, sample: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the pairs of rows (a, b) of `sketch`, those that agree in no sample before `sample`."""
    new = np.ones(len(a), dtype=bool)
    for s in range(sample):
        new &= sketch[a, s] != sketch[b, s]
    return new


def best_of_classes(classes: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` of each class in the given order."""
    ranked = order[np.argsort(classes[order], kind="stable")]
    own = classes[ranked]
    start = np.r_[True, own[1:] != own[:-1]]
    at = np.arange(len(own))
    return ranked[at - np.maximum.accumulate(np.where(start, at, 0)) < most]


def promising(threshold: float, most: int | None, block: int = 256):
    """A group's (g, sample, node, comp, sketch, n, bits) -> pairs (a, b) of different classes that may be alike."""

    def run(group: pa.Table) -> pa.Table:
        get = lambda c: group.column(c).to_numpy()
        node, comp, n, sample = get("node"), get("comp"), get("n"), int(get("sample")[0])
        fine = np.frombuffer(b"".join(group.column("bits").to_pylist()), dtype="<u8").reshape(len(node), FINE)
        bits = folded(fine)
        sketch = group.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        found = []
        for lo in range(0, len(node), block):
            differ = np.bitwise_count(bits[lo : lo + block, None] ^ bits[None, lo:]).sum(axis=2, dtype=np.int64)
            left, right = n[lo : lo + block, None], n[None, lo:]
            spare = left + right - 2 * threshold * np.maximum(left, right) - differ  # as in may_be_alike
            a, b = np.nonzero((spare >= -1e-6) & (comp[lo : lo + block, None] != comp[None, lo:]))
            a, b = a[a < b] + lo, b[a < b] + lo
            differ = np.concatenate([np.zeros(0, dtype=np.int64), *[np.bitwise_count(fine[a[i : i + 4096]] ^ fine[b[i : i + 4096]]).sum(axis=1, dtype=np.int64) for i in range(0, len(a), 4096)]])
            spare = n[a] + n[b] - 2 * threshold * np.maximum(n[a], n[b]) - differ
            found.append((a[spare >= -1e-6], b[spare >= -1e-6], (spare / (n[a] + n[b]))[spare >= -1e-6]))
        a, b, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if sample > 0:
            new = first_agreed(sketch, sample, a, b)
            a, b, score = a[new], b[new], score[new]
        if most is not None and len(a):
            order = np.lexsort((node[b], node[a], -score))
            best = np.unique(np.concatenate([best_of_classes(comp[x], order, most) for x in (a, b)]))
            a, b = a[best], b[best]
        return pa.table({"a": np.minimum(node[a], node[b]), "b": np.maximum(node[a], node[b])})

    return run


def verify(threshold: float):
    """(a, b, wa, wb) -> the pairs (a, b) that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [alike(np.frombuffer(x.as_py(), dtype="<u4"), np.frombuffer(y.as_py(), dtype="<u4"), threshold) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def word_bins(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labelled words of a text and their bins in the sketch of frequencies."""
    tokens = labelled_shingles(words, 1)
    return tokens, (tokens >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)


def frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words) -> (bin, texts): in how many texts of the partition the words of a bin occur, one row per bin at most."""
    sums = np.zeros(BINS, dtype=np.int64)
    for batch in batches:
        for w in batch.column(0):
            sums += np.bincount(word_bins(np.frombuffer(w.as_py(), dtype="<u4").astype(np.uint64))[1], minlength=BINS)
    found = np.nonzero(sums)[0]
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=["bin", "texts"])


def rare_words(words: np.ndarray, frequency: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The rarest labelled words of a text, of which any text that is alike has one among its own rarest, and their
    frequencies. An alignment covers `need` words at least, so a text can spare all but need - 1 of its words."""
    tokens, bins = word_bins(words)
    need = math.ceil(threshold * len(tokens) - 1e-9)
    of = frequency[bins]
    first = np.lexsort((tokens, of))[: len(tokens) - need + 1]
    return tokens[first], of[first]


def split_rows(frequency: np.ndarray, threshold: float, large: int):
    """(node, groups, words) -> (g, node): the member's new groups. A word that up to `large` texts have makes one group
    for all its texts, a more frequent one makes a group within each old group, and one that no other text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, nodes = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
            for node, groups, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens, of = rare_words(np.frombuffer(words, dtype="<u4").astype(np.uint64), frequency, threshold)
                few, many = tokens[(of > 1) & (of <= large)], tokens[of > large]
                inside = mix(np.array(groups, dtype=np.int64).view(np.uint64)[:, None] * STEP + many[None, :])
                out += [mix(few), inside.ravel()]
                nodes.append(np.full(len(few) + inside.size, node, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(nodes))], names=["g", "node"])

    return run


def gathered(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """`df`, known to have about `rows` rows, in as many partitions as they need: a small table in hundreds of them costs
    mostly files and task starts in every round that follows."""
    return df.coalesce(max(12, rows // per_task + 1))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of `edges` (a, b): alternating large-star and small-star rounds until stable."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    rows = 2 * edges.count()
    if not rows:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    few = lambda df: gathered(df, rows)
    edges, before = few(edges), None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = few(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        edges = few(few(both.filter("b > a").join(low, "a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        low = few(edges.groupBy("a").agg(F.min("b").alias("m")))
        edges = cut(few(few(edges.join(low, "a")).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return few(edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct())


def _members(table: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(g, sample, node) of the buckets that several nodes share, and (node, words, sketch) of those nodes."""
    nodes = cut(table.groupBy("node").agg(F.first("sketch").alias("sketch")))
    bands = nodes.select("node", F.posexplode("sketch").alias("sample", "g"))
    shared = cut(bands.groupBy("g").agg(F.count("*").alias("size")).filter("size > 1").select("g"))
    members = cut(bands.join(shared if shared.count() > MOST_KEYS else F.broadcast(shared), "g", "left_semi").select("g", "sample", "node"))
    chosen = cut(gathered(members.select("node").distinct(), members.count()))
    count = chosen.count()
    if not count:
        return None
    few = chosen if count > MOST_KEYS else F.broadcast(chosen)
    words = table.select("node", "words").join(few, "node", "left_semi").groupBy("node").agg(F.max("words").alias("words"))
    return members, cut(gathered(words.join(nodes.join(few, "node", "left_semi"), "node"), count, 5_000))


class _Search:
    """Compares the members of groups (g, node) until no pair of different classes is left untried.

    `links` are the verified pairs so far, `tested` all that were compared, `comps` the class of every node.
    """

    def __init__(self, members: DataFrame, words: DataFrame, threshold: float):
        self.words, self.threshold = words, threshold
        nodes = gathered(members.groupBy("node").agg(F.count("*").alias("weight")), members.count())
        schema = ", ".join(["node long", "bits binary", *[f"{c} long" for c in BOUNDS]])
        self.nodes = cut(nodes.join(words.select("node", "words").mapInArrow(bound_rows, schema), "node"))
        self.comps = self.nodes.select("node", F.col("node").alias("comp"))
        self.links: DataFrame | None = None
        self.tested: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> None:
        pairs = pairs.distinct()
        pairs = cut(pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti"))
        words = self.words.select("node", "words")
        if 2 * pairs.count() <= MOST_SENT:  # else about all words move
            words = words.join(F.broadcast(pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b"))), "node", "left_semi")
        with_words = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b")
        found = cut(with_words.select("a", "b", "wa", "wb").mapInArrow(verify(self.threshold), "a long, b long"))
        first = self.links is None
        self.tested = pairs if self.tested is None else self.tested.unionAll(pairs)
        self.links = found if first else self.links.unionAll(found)
        if not first:  # classes so far are the nodes of what is joined now
            comp = lambda c: self.comps.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
            found = found.join(comp("a"), "a").join(comp("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
        joined = components(found).select(F.col("node").alias("comp"), F.col("comp").alias("new"))
        joined = joined if joined.count() > MOST_SENT else F.broadcast(joined)
        self.comps = cut(self.comps.join(joined, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp")))

    def open(self, groups: DataFrame) -> DataFrame:
        """The members of the groups that hold several classes, with their class in `comp`."""
        rows = groups.count()
        groups = gathered(groups.drop("comp").join(self.comps, "node"), rows)
        several = gathered(groups.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("g"), rows)
        return cut(gathered(groups.join(several, "g", "left_semi"), rows))

    def lead(self, groups: DataFrame, best: int) -> None:
        """Compare each node with the `best` most central of the nodes that lead its groups."""
        rows = groups.count()
        weighed = gathered(groups.join(self.nodes.select("node", "weight"), "node"), rows)
        lead = gathered(weighed.groupBy("g").agg(F.max(F.struct("weight", "node")).alias("lead")), rows)
        met = gathered(weighed.join(lead, "g"), rows).filter("node <> lead.node").groupBy("node").agg(F.collect_set("lead").alias("leads"))  # a node's groups at most
        pairs = gathered(met, rows).select("node", F.explode(F.slice(F.sort_array("leads", asc=False), 1, best)).alias("lead"))
        self.compare(pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")))

    def join_pairs(self, groups: DataFrame) -> DataFrame:
        """All pairs of members (g, node, comp) of different classes that may be alike, by a join."""
        one = groups.select("g", "node", "comp").join(self.nodes.drop("weight", "bits"), "node")
        other = one.select("g", *[F.col(c).alias(f"c_{c}") for c in one.columns if c != "g"])
        met = one.join(other, (one["g"] == other["g"]) & (F.col("node") < F.col("c_node")) & (F.col("comp") != F.col("c_comp")) & may_be_alike(self.threshold))
        return met.select(F.col("node").alias("a"), F.col("c_node").alias("b"))

    def group_pairs(self, groups: DataFrame, most: int | None) -> DataFrame:
        """The same, a group (g, sample, node, comp) of up to LARGE members at a time; the `most` most promising of each
        class only, if given. A pair comes from the first sample that it agrees in."""
        rows = groups.join(self.nodes.select("node", "n", "bits"), "node").join(self.words.select("node", "sketch"), "node")
        return rows.select("g", "sample", "node", "comp", "sketch", "n", "bits").groupBy("g").applyInArrow(promising(self.threshold, most), "a long, b long")

    def split(self, groups: DataFrame, large: int) -> DataFrame:
        """(g, node): the members of large groups dealt by their rarest words. No pair that is alike loses its group."""
        each = cut(groups.groupBy("node").agg(F.collect_list("g").alias("groups")).join(self.words, "node"))  # a node has as many groups as samples at most
        sums = each.select("words").mapInArrow(frequency_rows, "bin long, texts long").groupBy("bin").agg(F.sum("texts").alias("texts")).collect()  # BINS rows at most
        frequency = np.zeros(BINS, dtype=np.int64)
        for r in sums:
            frequency[r["bin"]] = r["texts"]
        return cut(each.mapInArrow(split_rows(frequency, self.threshold, large), "g long, node long"))

    def centres(self, groups: DataFrame) -> None:
        """For groups too large to try all pairs: all members with ever more central ones, while there are classes left.
        A centre that has met all others is done; a group is closed when one class or no pair is left."""
        active, count = groups, 1
        order = Window.partitionBy("g").orderBy(F.desc("weight"), "node")
        while True:
            active = self.open(active)
            rows = active.count()
            if not rows:
                return
            known = active.join(self.nodes.drop("bits"), "node")
            centre = cut(known.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= count).select("g", *[F.col(c).alias(f"c_{c}") for c in ["node", "comp", *BOUNDS]]))
            met = known.join(centre, "g").filter((F.col("comp") != F.col("c_comp")) & may_be_alike(self.threshold))
            self.compare(met.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")))
            active = active.join(centre.select("g", F.col("c_node").alias("node")), ["g", "node"], "left_anti")
            count = max(FIRST_CENTRES, count * 8)


def _links(table: DataFrame, threshold: float, large: int, best: int = 4) -> _Search | None:
    """A search whose links connect every class of `table`; None if no two nodes share a bucket."""
    found = _members(table)
    if found is None:
        return None
    members, words = found
    search = _Search(members, words, threshold)
    search.lead(members, best)
    active = search.open(members)
    active = cut(active.join(active.groupBy("g").agg(F.count("*").alias("size")), "g"))
    small = active.filter(F.col("size") <= SMALL)
    middle = active.filter((F.col("size") > SMALL) & (F.col("size") <= large)).select("g", "sample", "node")
    crowded = active.filter(F.col("size") > large).select("g", "node")
    if crowded.limit(1).count():
        parts = search.split(crowded, large).withColumn("sample", F.lit(-1))
        full = cut(parts.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > large).select("g"))
        if full.limit(1).count():
            search.centres(cut(parts.join(full, "g").select("g", "node")))
            parts = parts.join(full, "g", "left_anti")
        middle = middle.unionByName(parts)
    search.compare(search.join_pairs(small))
    middle = cut(middle)
    for most in (PROMISING, None):
        middle = search.open(middle)
        if not middle.limit(1).count():
            break
        search.compare(search.group_pairs(middle, most))
    return search


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, samples: int = 40, per_sample: int = 2, large: int = LARGE) -> DataFrame:
    """One row per row of `docs`: id, class_id, class_size (rows), n_links (links found for its text), node and comp,
    the class's least node.

    Keys that many rows share (a text's node, a class) are summed before they are joined, and joined by broadcast of
    the few that are hot.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = cut(base.mapInArrow(sketch_rows(samples, per_sample), "id long, node long, sketch array<long>, words binary"))
    search = _links(table, threshold, large)
    rows = table.select("id", "node")
    nodes = rows.groupBy("node").agg(F.min("id").alias("low"), F.count("*").alias("rows"))
    if search is None:
        nodes = nodes.select("node", "low", "rows", F.col("node").alias("comp"), F.lit(0).cast("long").alias("n_links"))
    else:
        degree = search.links.unionAll(search.links.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"))
        nodes = nodes.join(search.comps, "node", "left").join(degree, "node", "left")
        nodes = nodes.select("node", "low", "rows", F.coalesce("comp", "node").alias("comp"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    nodes = cut(nodes)
    summary = cut(nodes.groupBy("comp").agg(F.min("low").alias("class_id"), F.sum("rows").alias("class_size"), F.count("*").alias("rows")))
    known = cut(join_unique(nodes.withColumnRenamed("rows", "n"), summary, "comp").select("node", "comp", "class_id", "class_size", "n_links", F.col("n").alias("rows")))
    found = join_unique(rows, known, "node")
    return found.select(F.col("id").alias(id_col), "class_id", "class_size", "n_links", "node", "comp")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that stay: of each class the row with the smallest doc_id, with all its columns.

    Of rows that repeat that id within the class one stays, the one with the smallest text.
    """
    found = cut(classes(docs, id_col, text_col, **settings))
    gone = cut(found.filter(~F.col(id_col).eqNullSafe(F.col("class_id"))).select(F.col(id_col).alias(temp("id"))).distinct())
    gone = gone if gone.count() > MOST_SENT else F.broadcast(gone)  # else texts move once
    again = found.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if again.limit(1).count() == 0:
        return docs.join(gone, F.col(id_col).eqNullSafe(F.col(temp("id"))), "left_anti").select(*columns)
    return _dedup_repeated_ids(docs, found, id_col, text_col).select(*columns)


def _dedup_repeated_ids(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For tables whose ids repeat: rows meet their class by (id, node), and one row of a class is taken."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = ChunkCache(_chunk_words)
        for texts in batches:
            nodes = [node_of(t or "", word_hashes(t or "", cache)) for part in text_slices(texts) for t in part]
            yield pa.array(np.array(nodes, dtype=np.uint64).view(np.int64))

    key = F.arrow_udf(run, "long")
    keep = found.filter(F.col(id_col).eqNullSafe(F.col("class_id"))).groupBy("comp").agg(F.first("class_id").alias(temp("id")), F.min("node").alias(temp("node"))).drop("comp")
    rows = docs.withColumn(temp("key"), key(F.col(text_col)))
    met = rows.join(keep, F.col(id_col).eqNullSafe(F.col(temp("id"))) & (F.col(temp("key")) == F.col(temp("node"))))
    return met.dropDuplicates([id_col, temp("key")])
