"""Language identification by a byte convolutional network.

Texts are cut into fixed windows of UTF-8 bytes. Filters of several widths run over each window; a filter is a table
of weights per position and byte value, so a convolution is a sum of look-ups. Each filter's maximum over the window
goes through a rectifier into a softmax over the languages. The network is trained in numpy on a bounded sample of
labelled windows; a text's prediction is the mean of its windows' probabilities, weighted by their letters.

Defined results: a text that is null or holds no letter is `und` with score 0; so is every text when nothing was
labelled; rows that repeat get the same answer; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import text_slices
from corpusloom.session import ship

#: Letters, and number signs that are no digits (a superscript, a fraction, a Roman numeral).
LETTER = re.compile(r"[^\W\d_]")
#: Bytes that stand for letters: ASCII letters and every byte of longer UTF-8 sequences.
IS_LETTER = np.array([chr(i).isascii() and chr(i).isalpha() or i >= 0x80 for i in range(256)])


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


@dataclass
class ByteCnn:
    """Tables (width, 256, filters) for each width, and the output layer."""

    labels: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    window: int

    def conv(self, x: np.ndarray, table: np.ndarray) -> np.ndarray:
        width, n = len(table), x.shape[1]
        out = table[0][x[:, : n - width + 1]]
        for j in range(1, width):
            out += table[j][x[:, j : n - width + 1 + j]]
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """(rows, filters of all widths) before bias. Neighbouring bytes share one look-up of a pair table."""
        out, pair_at = [], x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        for pairs in self.pair_tables():
            n, total = x.shape[1], None
            width = sum(2 if len(t) > 256 else 1 for t in pairs)
            at = 0
            for t in pairs:
                index = pair_at[:, at : at + n - width + 1] if len(t) > 256 else x[:, at : at + n - width + 1]
                part = t[index]
                total = part if total is None else np.add(total, part, out=total)
                at += 2 if len(t) > 256 else 1
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def pair_tables(self) -> list[list[np.ndarray]]:
        if not hasattr(self, "_pairs"):
            self._pairs = []
            for table in self.tables:
                parts = []
                for j in range(0, len(table), 2):
                    parts.append((table[j][:, None, :] + table[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < len(table) else table[j])
                self._pairs.append(parts)
        return self._pairs

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pairs"}

    def probabilities(self, x: np.ndarray, step: int = 256) -> np.ndarray:
        parts = []
        for lo in range(0, len(x), step):
            z = np.maximum(self.pooled(x[lo : lo + step]) + self.bias, 0) @ self.weights + self.offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)))


def windows(data: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, the last one of each padded with zeros, and how many each text has."""
    counts = np.array([max(1, -(-len(d) // window)) for d in data])
    joined = b"".join(d.ljust(n * window, b"\0") for d, n in zip(data, counts.tolist(), strict=True))
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, window), counts


def train(samples: list[tuple[bytes, str]], widths: tuple[int, ...] = (2, 3, 4), filters: int = 8, window: int = 256, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 5) -> ByteCnn | None:
    """Adam on the cross entropy of single windows. The gradient of a maximum goes to its first position alone."""
    labels = sorted({y for _, y in samples})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    x = windows([d[:window] for d, _ in samples], window)[0]
    y = np.array([labels.index(v) for _, v in samples])
    tables = [(rng.standard_normal((w, 256, filters)) * 0.1).astype("f4") for w in widths]
    total = filters * len(widths)
    model = ByteCnn(labels, tables, np.zeros(total, dtype="f4"), (rng.standard_normal((total, len(labels))) * 0.3).astype("f4"), np.zeros(len(labels), dtype="f4"), window)
    params = [*tables, model.bias, model.weights, model.offset]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    share = np.bincount(y, minlength=len(labels)) / len(y)
    balance = (1 / np.maximum(share, 1e-9) / len(labels)).astype("f4")[y]
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            some = order[lo : lo + batch]
            xb, yb = x[some], y[some]
            tops, ats = [], []
            for table in tables:
                c = model.conv(xb, table)
                at = c.argmax(axis=1)
                ats.append(at)
                tops.append(np.take_along_axis(c, at[:, None, :], axis=1)[:, 0])
            hidden = np.concatenate(tops, axis=1) + model.bias
            act = np.maximum(hidden, 0)
            z = act @ model.weights + model.offset
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p *= (balance[some] / len(yb))[:, None]
            back = (p @ model.weights.T) * (hidden > 0)
            grads, lo_f = [], 0
            for table, at in zip(tables, ats, strict=True):
                g = np.zeros_like(table)
                own = back[:, lo_f : lo_f + filters]
                f = np.broadcast_to(np.arange(filters), at.shape)
                for j in range(len(table)):
                    np.add.at(g[j], (xb[np.arange(len(xb))[:, None], at + j], f), own)
                grads.append(g)
                lo_f += filters
            grads += [back.sum(axis=0), act.T @ p, p.sum(axis=0)]
            t += 1
            for param, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def sample(docs: DataFrame, labelled: Column, id_col: str, text_col: str, lang_col: str, max_docs: int, per_doc: int, window: int) -> list[tuple[bytes, str]]:
    """Windows of at most `max_docs` labelled texts, those with the smallest hashes; per text at spread offsets.

    The bound holds for any input, so the result fits the driver: max_docs x per_doc windows.
    """
    text = F.col(text_col)
    spread = F.array(*[F.substring(text, F.lit(1) + (F.length(text) * i / per_doc).cast("int"), F.lit(window)) for i in range(per_doc)])
    rows = docs.filter(labelled & F.col(lang_col).isNotNull() & text.isNotNull())
    known = rows.count()
    # about twice as many as wanted are drawn by hash first, so that what reaches the driver doesn't grow with the tasks
    share = min(1.0, (2 * max_docs + 100) / max(1, known))
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))
    rows = (
        rows.filter(drawn)
        .filter(text.rlike(r"\p{L}"))
        .select(F.xxhash64(F.col(id_col).cast("string"), text).alias("r"), F.array_distinct(spread).alias("w"), F.col(lang_col).alias("y"))
        .orderBy("r", "y", "w")
        .limit(max_docs)
        .collect()
    )
    return [(w.encode("utf-8", "surrogatepass"), r["y"]) for r in rows for w in r["w"] if has_letter(w)]


def fit(docs: DataFrame, labelled: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 2000, per_doc: int = 4, window: int = 256) -> ByteCnn | None:
    ship(docs.sparkSession)
    labelled = F.lit(True) if labelled is None else labelled
    return train(sample(docs, labelled, id_col, text_col, lang_col, max_docs, per_doc, window), window=window)


def predict_texts(model: ByteCnn | None, texts: list[str | None], budget: int = 1 << 22) -> tuple[list[str], list[float]]:
    """Labels and scores. Texts are taken in runs of about `budget` bytes, so long ones stay within memory."""
    labels, scores = ["und"] * len(texts), [0.0] * len(texts)
    at = 0
    todo = [i for i, t in enumerate(texts) if model is not None and isinstance(t, str) and has_letter(t)]
    while at < len(todo):
        run, size = [], 0
        while at < len(todo) and (not run or size < budget):
            run.append(todo[at])
            size += len(texts[todo[at]])
            at += 1
        x, counts = windows([texts[i].encode("utf-8", "surrogatepass") for i in run], model.window)
        weight = IS_LETTER[x].sum(axis=1).astype("f8") + 1e-6
        sums = np.add.reduceat(model.probabilities(x) * weight[:, None], np.r_[0, np.cumsum(counts)[:-1]], axis=0)
        sums /= sums.sum(axis=1, keepdims=True)
        best = sums.argmax(axis=1)
        for i, b, s in zip(run, best.tolist(), sums.max(axis=1).tolist(), strict=True):
            labels[i], scores[i] = model.labels[b], min(1.0, s)
    return labels, scores


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(model: ByteCnn | None):
    """An Arrow UDF: text -> struct(lang_pred, score)."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [predict_texts(model, part) for part in text_slices(texts)]
            labels, scores = (pa.array([x for f in found for x in f[i]], kind) for i, kind in ((0, pa.string()), (1, pa.float64())))
            yield pa.StructArray.from_arrays([labels, scores], names=["lang_pred", "score"])

    return F.arrow_udf(run, RESULT)
