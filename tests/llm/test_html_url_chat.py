import math
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import html, preference, urlfilter
from corpusloom.llm.queries import RULES

BODY = "The first paragraph of the article holds a good number of words, and says something."
MORE = "A second paragraph follows &amp; goes on for quite a while, so that the article is long."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        (f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{BODY}<p><b>{MORE}</b><br>end</article><footer>f</footer>", f"T {BODY} {MORE.replace('&amp;', '&')} end"),
        (f"<body><div class='menu'><a>one</a><a>two</a></div><div id=content><p>{BODY}</p><p>{MORE}</p></div><div class='sidebar'><p>{BODY}</p></div><div class=comments><p>{BODY}</p></div></body>", f"{BODY} {MORE.replace('&amp;', '&')}"),
        (f"<body><div class=cookie-notice>We use cookies</div><main><div><p>{BODY}</p></div><aside>side</aside><form>name <input></form><p>{MORE}</p></main></body>", f"{BODY} {MORE.replace('&amp;', '&')}"),
        (f"<article><header><h1>Title</h1></header><p>{BODY}</p><ul><li>one<li>two</ul></article>", f"Title {BODY} one two"),
        ("<article><p>a  b\n\tc&nbsp;d&#233;</p></article>", "a b c dé"),
        (f"<body><div class='layout with-sidebar'><div class=sidebar>s</div><article><p>{BODY}</p></article><section class=comments><article class=comment><p>{BODY}</p></article></section></div></body>", BODY),
        (f"<body><div class=comments><article class='comment reply'><p>{BODY}</p></article></div><div><p>{MORE}</p></div></body>", MORE.replace("&amp;", "&")),
        ("<script>var x = '</p>';</script><style>p{}</style><article>x</article>", "x"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='layout with-sidebar'><div class=menu><a>one</a></div><div class='content'><p>{BODY}</p><p>{BODY}</p></div><div class=sidebar><p>side</p></div></div></body>",
        f"<body><form action=x><div class=nav><a>one</a></div><div><p>{BODY}</p><p>{BODY}</p></div></form></body>",
        f"<body><div class='page with-sidebar'><div class=elementor-widget><p>{BODY}</p></div><div class=elementor-widget><p>{BODY}</p></div><div class=comments><p>{MORE * 9}</p></div></div></body>",
    ],
)
def test_frames_of_plain_divs(page):
    assert html.main_text(page) == f"{BODY} {BODY}"
    assert html.main_text(f"<body><div hidden class=widget><p>{BODY}</p></div><div class=comments><p>{BODY}</p></div></body>") == ""


def test_html_never_fails():
    rng = random.Random(1)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<b>", "</b>", "<table><tr><td>", "</table>", "text ", "&amp;", "&#x41;", "<!-- c -->", "<", ">", "<a href='x'>", "</a>", "<script>", "</script>", "<li>", "</html>", "<body>", "<br/>", "<td>", "<![CDATA[x]]>", "<svg/>"]
    for _ in range(3000):
        html.main_text("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))))
    assert html.main_text("<div>" * 3000 + "deep words" + "</div>" * 3000) == "deep words"


def test_unknown_marked_sections_are_comments():
    assert html.main_text("<article><p>one</p><![foo[bar]]><p>two</p></article>") == "one two"
    assert html.main_text("<article>Some text <![x y>and more</article>") == "Some text and more"
    assert html.main_text("<p>a</p><![ [b]><p>c</p>") == "a c"
    assert html.main_text("<p>open</p><![foo[").startswith("open")


def test_html_query_shape(spark):
    pages = spark.createDataFrame([(1, None, 5), (2, f"<article>{BODY}</article>", 6)], "page_id long, html string, chars int")
    assert {r["page_id"]: r["text"] for r in html.extract(pages).collect()} == {1: "", 2: BODY}
    assert html.extract(pages.limit(0)).count() == 0


def plain_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12?x=http://b.com/", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/de/#a", "http://com/fr/x", "http://notcom/fr/", "a://b://c.org/", "http://É.org/", "http://x.org", "http://x.org?y", "http://x.net/\nes"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    u = F.col("url")
    m = urlfilter.match(urlfilter.host(u), urlfilter.path(u), RULES)
    for r in df.select("url", urlfilter.host(u).alias("h"), urlfilter.path(u).alias("p"), m["rule"].alias("r"), m["verdict"].alias("v")).collect():
        assert (r["h"], r["p"], r["r"], r["v"]) == plain_rule(r["url"]), r["url"]


def test_entropy(spark):
    for text in ("", "aaaa", "abab", "http://é/é"):
        n = len(text)
        want = -sum(text.count(c) / n * math.log2(text.count(c) / n) for c in set(text)) if n else 0.0
        assert abs(spark.createDataFrame([(text,)], "t string").select(urlfilter.entropy(F.col("t")).alias("e")).first()["e"] - want) < 1e-9


def test_trees_learn_and_score(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(600):
        bad = rng.random() < 0.4
        host = rng.choice(["good.net", "fine.net"]) if not bad else rng.choice(["pills-now.biz", "x-1.biz"])
        path = "/".join(str(rng.randint(10**6, 10**7)) if bad else rng.choice(["news", "about"]) for _ in range(rng.randint(1, 4)))
        rows.append((f"http://{host}/{path}" + ("?a=1&b=2" if bad else ""), bad))
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    model = urlfilter.train(df.limit(400))
    assert model.trees
    again = urlfilter.train(df.limit(400).repartition(5))
    assert again == model
    got = urlfilter.judge(df, [], model)
    right = got.filter(F.col("blocked") == (F.col("__cl_verdict") == "block")).count()
    assert right >= 0.97 * len(rows)
    # the expression gives what walking the trees gives
    one = got.select(*[F.col(f"__cl_{f}").alias(f) for f in urlfilter.FEATURES], "__cl_p").limit(30).collect()
    for r in one:
        margin = model.base
        for t in model.trees:
            while not isinstance(t, float):
                t = t[2] if r[t[0]] <= model.edges[t[0]][t[1]] else t[3]
            margin += t
        assert abs(1 / (1 + math.exp(-margin)) - r["__cl_p"]) < 1e-9


@pytest.mark.parametrize("labels, verdict", [([], "allow"), ([True], "block"), ([False, None], "allow")])
def test_few_labels(spark, labels, verdict):
    df = spark.createDataFrame([("http://a.b/c", x) for x in labels], "url string, blocked boolean")
    model = urlfilter.train(df)
    out = urlfilter.judge(spark.createDataFrame([(None, "x"), ("http://q/", "y")], "url string, host string"), [], model)
    assert {r["__cl_verdict"] for r in out.collect()} == {verdict}
    assert urlfilter.judge(df.limit(0), RULES, model).count() == 0


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def spans(turns):
    out, at = [], 0
    for r, t in turns:
        whole = f"<|im_start|>{r}\n{t}<|im_end|>\n"
        if r == "assistant":
            out.append(f"{at + len(f'<|im_start|>{r}') + 1}-{at + len(whole)}")
        at += len(whole)
    return ",".join(out)


def test_format_pairs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        a = [(rng.choice(["user", "assistant"]), rng.choice(["x", "yé", ""])) for _ in range(rng.randint(0, 5))]
        b = a[: rng.randint(0, len(a))] + [(rng.choice(["user", "assistant", "tool"]), rng.choice(["x", "z"])) for _ in range(rng.randint(0, 3))]
        rows.append((i, a, b, "extra"))
    kind = "array<struct<role: string, text: string>>"
    got = preference.format_pairs(spark.createDataFrame(rows, f"conv_id long, chosen {kind}, rejected {kind}, other string")).collect()
    for r in got:
        a, b = [tuple(t) for t in r["chosen"]], [tuple(t) for t in r["rejected"]]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert (r["prompt_turns"], r["prompt"]) == (n, render(a[:n]))
        assert (r["chosen_text"], r["chosen_mask"]) == (render(a[n:]), spans(a[n:]))
        assert (r["rejected_text"], r["rejected_mask"]) == (render(b[n:]), spans(b[n:]))


def test_mismatched_pairs(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 1, "assistant", "b"), (1, 0, None, None), (1, 2, "user", "later"), (2, 0, "user", "alone"), (3, 0, "assistant", "c"), (None, 0, "user", "x"), (4, None, "assistant", "d"), (4, 1, "user", "u"), (5, 0, "assistant", "d"), (5, 0, "assistant", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["chosen"], r["rejected"]) for r in preference.mismatched_pairs(df).collect()}
    assert set(got) == {0, 1, 4, 5}
    assert [tuple(t) for t in got[1][0]] == [("user", ""), ("assistant", "b")] and [tuple(t) for t in got[1][1]] == [("user", ""), ("assistant", "a")]
    assert [tuple(t) for t in got[4][0]] == [("assistant", "d")]
    assert preference.mismatched_pairs(df.limit(0)).count() == 0


ARTICLE = f"{BODY} {BODY}"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><form><p>{BODY}</p><p>{BODY}</p></form></body>", ARTICLE),
        (f"<body><div class='page no-sidebar'><p>{BODY}</p><p>{BODY}</p></div></body>", ARTICLE),
        (f"<body class='page has-header'><div class='has-header'><p>{BODY}</p><p>{BODY}</p></div></body>", ARTICLE),
        (f"<body><div class='widget-content'><p>{BODY}</p><p>{BODY}</p></div></body>", ARTICLE),
        (f"<body><div id='post-comments-open'><p>{BODY}</p><p>{BODY}</p></div></body>", ARTICLE),
        (f"<article><p>{BODY}</p><p class='notice'>{BODY}</p><p class='social-history'>s</p><div class='ad-free'>a</div></article>", f"{ARTICLE} s a"),
        (f"<body><nav><a href=x>one</a></nav><div><h1>Title</h1><div><p>{BODY}</p><p>{BODY}</p></div></div><footer>f</footer></body>", f"Title {ARTICLE}"),
        (f"<body><form class=search>find</form><div class=site-header>head</div><main><p>{BODY}</p><p>{BODY}</p></main></body>", ARTICLE),
    ],
)
def test_furniture_is_evidence_and_no_verdict(page, text):
    assert html.main_text(page) == text


def test_density_finds_the_article_without_its_tag():
    import pandas as pd

    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    want = [html.main_text(p) for p in pages]
    plain = lambda p: re.sub("<(/?)article", r"<\1div", p)
    assert [html.main_text(plain(p)) for p in pages] == want
    bare = lambda p: re.sub(r"<(/?)(?:nav|footer)\b", r"<\1div", plain(p).replace('class="ad"', ""))
    assert sum(html.main_text(bare(p)) == w for p, w in zip(pages, want)) >= 0.95 * len(pages)  # no tag or name helps


def test_densities_against_a_plain_version():
    rng = random.Random(9)

    def grow(depth):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.4 and parts and isinstance(parts[-1], str):
                continue  # neighbours would be one text
            if kind < 0.4 or depth > 5:
                parts[-1:] = parts[-1:] if not (parts and isinstance(parts[-1], str)) else []
                parts.append("".join(rng.choice("ab c") for _ in range(rng.randint(1, 60))))
            else:
                tag = rng.choice(["div", "a", "span", "section", "nav"])
                parts.append((tag, grow(depth + 1)))
        return parts

    def source(parts):
        return "".join(p if isinstance(p, str) else f"<{p[0]}>{source(p[1])}</{p[0]}>" for p in parts)

    def flat(parts):
        return [p for p in parts if not isinstance(p, str)] + [x for p in parts if not isinstance(p, str) for x in flat(p[1])]

    def chars(parts, only_links=False, inside=False):
        own = lambda t: len(" ".join(t.split())) if (inside or not only_links) else 0
        return sum(own(p) if isinstance(p, str) else chars(p[1], only_links, inside or p[0] == "a") for p in parts)

    for _ in range(200):
        parts = [p for p in grow(0) if not isinstance(p, str)]
        root = html.parse(f"<body>{source(parts)}</body>")
        nodes = html.measure(root)
        share = chars(parts, True) / max(1, chars(parts))
        weighted = {}

        def check(node, tag, parts, weight, share=share, weighted=weighted, total=chars(parts)):
            c, lc = chars(parts, inside=tag == "a"), chars(parts, True, tag == "a")
            t, lt = max(1, len(flat(parts))), max(1, sum(x[0] == "a" for x in flat(parts)))
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e) if c else 1
            want = c / t * math.log(1 + max(0, (c - lc) / max(1, lc)) * t / lt) / (1 + math.log(base)) if c else 0
            weight *= 0.1 if tag == "nav" and 2 * c <= total else 1
            assert abs(node.density - want) < 1e-9 and abs(node.weight - weight) < 1e-12, tag
            kids = html.kept(node)
            inner = [p for p in parts if not isinstance(p, str)]
            assert [k.tag for k in kids] == [p[0] for p in inner]
            weighted[id(node)] = weight * want
            for kid, (name, below) in zip(kids, inner):
                check(kid, name, below, weight)
            assert abs(node.total - sum(weighted[id(k)] for k in kids)) < 1e-9

        check(html.kept(root)[0], "body", parts, 1.0)
        assert html.leader(nodes).total == max(n.total for n in nodes)


def test_html_clashing_repeated_and_long(spark):
    long = "<article>" + "".join(f"<p>{BODY} {i}</p>" for i in range(20000)) + "</article>"
    pages = spark.createDataFrame([(1, long, "old"), (2, f"<article>{BODY}</article>", "old"), (2, f"<article>{BODY}</article>", "old")], "page_id long, html string, text string")
    got = html.extract(pages).collect()
    assert sorted(len(r["text"]) for r in got) == sorted([len(BODY), len(BODY), sum(len(f"{BODY} {i}") + 1 for i in range(20000)) - 1])
    assert pages.columns == html.extract(pages).columns


def test_url_ties_repeats_and_long(spark):
    long = "http://a.net/" + "x1/" * 50_000
    rows = [("http://a.net/1", True), ("http://b.net/2", False)] * 40 + [(long, True), (None, False)]
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    model = urlfilter.train(df)
    assert urlfilter.train(df.repartition(3)) == model
    got = urlfilter.judge(df, RULES, model).collect()
    assert len(got) == len(rows) and len({(r["url"], r["__cl_verdict"]) for r in got}) == 4


def test_rates_leave_the_own_label_out(spark):
    rng = random.Random(3)
    rows = [(f"http://h{i}.s{i}/", rng.random() < 0.5) for i in range(400)]  # suffixes that tell nothing
    model = urlfilter.train(spark.createDataFrame(rows, "url string, blocked boolean"))
    assert not any("suffix_rate" in str(t) for t in model.trees[:1])


def test_preference_long_turns_and_names(spark):
    rows = [(i, t, "assistant" if t % 2 else "user", f"{i}-{t}" + "x" * (100_000 if t == 1 else 0)) for i in range(2) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = preference.mismatched_pairs(df).withColumn("prompt", F.lit("old")).withColumn("extra", F.lit(1))
    got = {r["conv_id"]: r for r in preference.format_pairs(pairs).collect()}
    assert got[0]["prompt_turns"] == 1 and got[1]["prompt_turns"] == 3 and got[0]["extra"] == 1
    assert got[1]["prompt"] == render([(r[2], r[3]) for r in rows if r[0] == 1][:3])
    assert got[0]["chosen_mask"].count("-") == 3 and got[0]["rejected_text"].startswith("<|im_start|>assistant\n1-3<")
