"""URL filtering by rules and, where no rule fits, by gradient-boosted trees on lexical features (native).

Rules are a host and a path prefix; a rule fits its host and all subdomains, and the longest fitting rule decides.
The trees are trained from labelled URLs: each round adds a tree of depth two to the log odds, grown from histograms
of gradients that Spark sums per leaf, feature and bin. Gradients are rounded to integers before they are summed, so
the model doesn't depend on the order of rows. The finished model is one column expression.

Defined results: a url that is null or has no "://" has empty host and path and is judged by the trees; features of an
empty url are zeros; urls of any length are read whole; without labels, or with labels of one kind, the verdict is that
kind (allow if there are none); of splits of equal gain the first feature by name and the lowest bin win; repeated rows
get the same verdict; other columns are left alone by `judge`, which adds names with a prefix; an empty table gives an
empty result. Suffix statistics are smoothed rates of blocked urls, for the urls of a fold from the other folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, cut, temp

SCALE = 1 << 20
#: Rows that the mean rate weighs in the rate of a suffix.
PRIOR = 4
FEATURES = ("length", "depth", "digit_ratio", "entropy", "parameters", "host_labels", "hyphens", "suffix_rate", "section_rate")
#: Folds of the labelled urls; a url's rates come from the other folds.
FOLDS = 5


def host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/?[^?#]*)", 1), F.lit(""))


def match(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null. `rules`: (verdict, "host/path-prefix")."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host_ == name) | F.endswith(host_, F.lit(f".{name}"))) & F.startswith(path_, F.lit(f"/{prefix}"))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character of the text's characters."""
    n = F.length(text).cast("double")
    share = lambda ch: (F.length(text) - F.length(F.replace(text, ch, F.lit("")))) / n
    total = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, ch: acc - F.when(ch == "", 0.0).otherwise(share(ch) * F.log2(share(ch))))
    return F.when(n > 0, total).otherwise(0.0)


def suffix(host_: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host_, ".", -2)


def statistics(url: Column) -> dict[str, Column]:
    """What rates of blocked urls are kept of: the host's suffix, alone and with the first label of the path."""
    u = F.coalesce(url, F.lit(""))
    own = suffix(host(u))
    return {"suffix_rate": own, "section_rate": F.concat_ws("/", own, F.regexp_extract(path(u), "^/([^/]*)", 1))}


def lexical(url: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    h, p = host(u), path(u)
    count = lambda pattern, c: F.regexp_count(c, F.lit(pattern)).cast("double")
    return {
        "length": F.length(u).cast("double"),
        "depth": count("/[^/]", p),
        "digit_ratio": count("[0-9]", u) / n,
        "entropy": entropy(u),
        "parameters": count("[?&][^=&#]+=", u),
        "host_labels": count(r"[^.]+", h),
        "hyphens": count("-", h),
    }


@dataclass
class Model:
    """Bin edges of each feature, trees as (feature, bin, leaf values or splits), smoothed rates by statistic and value."""

    base: float
    edges: dict[str, list[float]]
    trees: list[tuple]
    rates: dict[str, dict[str, float]]
    rate: float

    def measure(self, pages: DataFrame, url: Column) -> DataFrame:
        """`pages` with the features of `url`, named by `temp`. The rates, at most `max_rows` of each kind, are broadcast."""
        values, own = lexical(url), temp("value")
        for name, value in statistics(url).items():
            rates = self.rates.get(name, {})
            table = pages.sparkSession.createDataFrame(pa.table({own: pa.array(list(rates), pa.string()), temp(name): pa.array(list(rates.values()), pa.float64())}))
            pages = pages.withColumn(own, value).join(F.broadcast(table), own, "left").drop(own)
            values[name] = F.coalesce(temp(name), F.lit(self.rate))
        return pages.withColumns({temp(f): c for f, c in values.items()})

    def margin(self, values: dict[str, Column], edges: dict[str, list[float]] | None = None) -> Column:
        out = F.lit(self.base)
        for tree in self.trees:
            out = out + _tree(tree, values, edges)
        return out

    def probability(self, url: Column) -> Column:
        """Of `block`, from columns made by `measure`."""
        own = {f: F.col(temp(f)) for f in self.edges}
        return 1.0 / (1.0 + F.exp(-self.margin(own, self.edges)))


def _bin(value: Column, edges: list[float]) -> Column:
    """How many edges lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < value))


def _tree(tree, values: dict[str, Column], edges: dict[str, list[float]] | None) -> Column:
    """On bins, or on plain values where `edges` are given: a value's bin is at most b if it is at most edge b."""
    if isinstance(tree, float):
        return F.lit(tree)
    feature, at, left, right = tree
    limit = F.lit(at if edges is None else float(edges[feature][at]))
    return F.when(values[feature] <= limit, _tree(left, values, edges)).otherwise(_tree(right, values, edges))


def _best(hist: dict[str, dict[int, tuple[int, int]]], ridge: float) -> tuple[str, int, float, float] | float:
    """The split of largest gain and the two leaf values, or one leaf value if no split gains."""
    some = next(iter(hist.values()))
    g_all, h_all = (sum(v[i] for v in some.values()) / SCALE for i in (0, 1))
    score = lambda g, h: g * g / (h + ridge)
    best, found = 1e-6, None
    for f in sorted(hist):
        g = h = 0.0
        for b in sorted(hist[f])[:-1]:
            g, h = g + hist[f][b][0] / SCALE, h + hist[f][b][1] / SCALE
            gain = score(g, h) + score(g_all - g, h_all - h) - score(g_all, h_all)
            if gain > best + 1e-12:
                best, found = gain, (f, b, g / (h + ridge), (g_all - g) / (h_all - h + ridge))
    return found if found else g_all / (h_all + ridge)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", max_rows: int = 20_000, trees: int = 8, bins: int = 16, rate: float = 0.4, ridge: float = 1.0) -> Model:
    """Fit on at most `max_rows` labelled URLs, those with the smallest hashes; `label_col` is boolean.

    What the driver collects is bounded by features x bins sums a pass, and by `max_rows` suffixes.
    """
    rows = labelled.filter(F.col(label_col).isNotNull()).select(F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.col(label_col).cast("int").alias("y"))
    # about twice as many as wanted are drawn by hash first, so that the ordered limit doesn't grow with the tasks
    share = min(1.0, (2 * max_rows + 100) / max(1, rows.count()))
    rows = rows.withColumn("r", F.xxhash64("url", "y")).filter(F.pmod("r", F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("r", "url").limit(max_rows)
    values, plain = statistics(F.col("url")), lexical(F.col("url"))
    fold = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS))
    rows = cut(rows.select("y", fold.alias("fold"), *[c.alias(f"of_{f}") for f, c in values.items()], *[c.alias(f) for f, c in plain.items()]))
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or positive in (0, n):
        import math

        return Model(math.log(19.0) if n and positive else -math.log(19.0), {}, [], {}, 0.0)
    share = positive / n
    model = Model(0.0, {}, [], {}, share)
    smooth = lambda k, n: (k + PRIOR * share) / (n + PRIOR)
    for name in values:  # a row's rates leave its fold out: rates with its own label would tell the label
        own = f"of_{name}"
        sums = cut(rows.groupBy(own, "fold").agg(F.count("*").alias("n"), F.sum("y").alias("k")))  # `max_rows` at most
        whole = sums.groupBy(own).agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"))
        model.rates[name] = {r[own]: smooth(r["all_k"], r["all_n"]) for r in whole.orderBy(own).collect()}
        met = sums.join(whole, own).select(own, "fold", smooth(F.col("all_k") - F.col("k"), F.col("all_n") - F.col("n")).alias(name))
        rows = rows.join(F.broadcast(met), [own, "fold"])
    cuts = [i / bins for i in range(1, bins)]
    edges = rows.agg(*[F.percentile_approx(f, cuts, 10_000).alias(f) for f in FEATURES]).first()
    model.edges = {f: sorted(set(edges[f])) for f in FEATURES}
    binned = cut(rows.select("y", *[_bin(F.col(f), model.edges[f]).alias(f) for f in FEATURES]))
    own = {f: F.col(f) for f in FEATURES}
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES]))

    def histograms(leaf: Column) -> dict[int, dict]:
        p = 1.0 / (1.0 + F.exp(-model.margin(own)))
        graded = binned.select(leaf.alias("leaf"), F.round((F.col("y") - p) * SCALE).cast("long").alias("g"), F.round(p * (1 - p) * SCALE).cast("long").alias("h"), each.alias("x"))
        sums = graded.groupBy("leaf", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        out: dict[int, dict] = {}
        for r in sums:
            out.setdefault(r["leaf"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
        return out

    def shrink(found) -> tuple | float:
        return rate * found if isinstance(found, float) else (found[0], found[1], rate * found[2], rate * found[3])

    for _ in range(trees):
        root = _best(histograms(F.lit(0))[0], ridge)
        if isinstance(root, float):
            break
        hist = histograms(F.when(own[root[0]] <= root[1], 0).otherwise(1))
        model.trees.append((root[0], root[1], shrink(_best(hist[0], ridge)), shrink(_best(hist[1], ridge))))
    return model


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], model: Model, url_col: str = "url") -> DataFrame:
    """`pages` with host, path, rule, verdict and p_block, in columns named with a prefix that `temp` gives."""
    url = F.col(url_col).cast("string")
    out = pages.withColumns({temp("host"): host(url), temp("path"): path(url)})
    out = model.measure(out, url) if model.trees else out
    out = out.withColumns({temp("match"): match(F.col(temp("host")), F.col(temp("path")), rules), temp("p"): model.probability(url)})
    by_model = F.when(F.col(temp("p")) >= 0.5, "block").otherwise("allow")
    return out.withColumns({temp("rule"): F.col(temp("match"))["rule"], temp("verdict"): F.coalesce(F.col(temp("match"))["verdict"], by_model)})
