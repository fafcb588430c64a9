"""Main text of web pages by composite text density.

The page becomes a tree; only what is never text (scripts, styles, form controls, hidden elements) and reader comments
are left out beforehand. Every other element has a density, its characters per tag adjusted for link characters and
link tags, and a sum, its children's densities. The element with the largest sum leads. Around it, level by level up to
the body, its neighbours join whose density reaches the least density on that path and whose text is not mostly links;
main headings before it join too. The text of what was chosen is joined block by block in page order.

Tags, roles and class names that usually mean page furniture (menus, page headers, sidebars, notices, adverts, forms) are
evidence and no verdict: the densities below such an element count a tenth, and it is left out of the result unless the
leading element lies in it. So a form, a frame named `with-sidebar` or a `widget` around the article hides nothing. On a
page without article or main, class names whose elements hold most of the text mean nothing.

Defined results: null or empty html, and pages without text, give an empty text; character references are decoded;
white space inside a block becomes one space; broken nesting is mended as browsers do for paragraphs, list items and
table cells; nothing is dropped or capped by length; of equal sums the outermost and first element leads; repeated rows
get the same text; an input column named like the result is replaced, all others pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import text_slices
from corpusloom.session import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose text is never part of a page's prose.
NEVER = frozenset("script style noscript template svg math head title button select textarea input iframe object embed canvas audio video map datalist".split())
#: Tags and roles that usually hold page furniture.
CUE_TAGS = frozenset("nav footer aside form dialog menu header".split())
CUE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Elements that may be furniture by their class or id: containers, not the blocks of running text.
CONTAINERS = frozenset("address aside center details dialog div dl fieldset figure footer form header menu nav ol section table td ul".split())
#: Head nouns of class and id names of page furniture, and of comments.
CUE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense banner breadcrumb breadcrumbs consent cookie cookies footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split()
)
COMMENTS = frozenset(["comment", "comments", "commentlist", "disqus", "replies", "reply", "respond"])
#: After a furniture word, these name its container; a name that starts with one of the others says something else.
HOLDERS = frozenset("area bar block box buttons container form inner items item links list section signup slot unit wrap wrapper".split())
STATES = frozenset("has have is no non not show hide with without".split())
OWN = frozenset("article content entry post story".split())
#: What densities below an element that looks like furniture count.
CUE_WEIGHT = 0.1
#: Beside the path, but inside a container of the page, this share of the threshold is enough.
INNER = 0.5
PAGE = frozenset(["body", "html", "#root"])
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
#: Start tags that end an open element of these names, up to the given parents.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "items", "skip", "cues", "weight", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, skip: bool = False, cues: frozenset[str] = frozenset()):
        self.tag, self.parent, self.skip, self.cues = tag, parent, skip, cues
        self.items: list[Node | str] = []


def named(value: str, nouns: frozenset[str]) -> set[str]:
    """Which of `nouns` the names in a class or id attribute are about: `site-header` and `ad-slot`, but neither
    `no-sidebar` nor `ad-free`."""
    out = set()
    for name in value.split():
        parts = [w.lower() for w in WORDS.findall(name)]
        if not parts or parts[0] in STATES:
            continue
        if parts[-1] in nouns:
            if not (parts[0] in OWN and parts[-1] == "header"):
                out.add(parts[-1])
        elif parts[0] in nouns and parts[-1] in HOLDERS:
            out.add(parts[0])
    return out


def judged(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element is left out beforehand, and what else makes it look like furniture (tags as `<tag>`)."""
    if tag in NEVER:
        return True, frozenset()
    cues = {f"<{tag}>"} if tag in CUE_TAGS and not (tag == "header" and inside_article) else set()
    if tag in ("html", "body", "main"):
        return False, frozenset()
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, frozenset()
        if not value:
            continue
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, frozenset()
        if name == "role" and value.lower() in CUE_ROLES:
            cues.add(f"<{value.lower()}>")
        if name in ("class", "id") and (tag in CONTAINERS or tag == "article"):
            if named(value, COMMENTS):
                return True, frozenset()
            if tag != "article":
                cues |= named(value, CUE_NAMES) - ({"header"} if inside_article else set())
    return False, frozenset(cues)


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)
        self.depth: dict[str, int] = {}
        self.found = False

    def push(self, node: Node) -> None:
        if node.tag in ("article", "main") and not node.skip:
            above = self.at
            while above is not None and not above.skip:
                above = above.parent
            self.found = self.found or above is None
        self.at.items.append(node)
        self.at = node
        self.depth[node.tag] = self.depth.get(node.tag, 0) + 1

    def pop_to(self, tag: str) -> None:
        while True:
            done = self.at.tag == tag
            self.depth[self.at.tag] -= 1
            self.at = self.at.parent
            if done:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and self.depth.get(tag):
            return
        if tag in CLOSES_P and self.depth.get("p") and self.near("p", {"td", "th", "table", "button"}):
            self.pop_to("p")
        if tag in ENDS:
            for name in ENDS[tag][0]:
                if self.depth.get(name) and self.near(name, ENDS[tag][1]):
                    self.pop_to(name)
                    break
        if tag == "body" and self.depth.get("head"):
            self.pop_to("head")
        inside = bool(self.depth.get("article") or self.depth.get("main"))
        node = Node(tag, self.at, *judged(tag, attrs, inside))
        if tag in VOID:
            self.at.items.append(node)
        else:
            self.push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # browsers ignore the slash of elements that aren't void

    def near(self, tag: str, walls: set[str]) -> bool:
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                return True
            if node.tag in walls:
                return False
            node = node.parent
        return False

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body") or not self.depth.get(tag):
            return
        if tag not in BLOCK:  # an inline end tag doesn't close blocks around it
            node = self.at
            while node.tag != tag:
                if node.tag in BLOCK:
                    return
                node = node.parent
        self.pop_to(tag)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no section that the parser knows; to browsers a comment up to the next `>`
            return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        if data:
            self.at.items.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    if not builder.found:
        forget_common_names(builder.root)
    return builder.root


def kept(node: Node) -> list[Node]:
    """The children that are not left out beforehand."""
    return [x for x in node.items if isinstance(x, Node) and not x.skip]


def postorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(kept(node))
    return out[::-1]


def text_length(text: str) -> int:
    return len(SPACE.sub(" ", text).strip())


def forget_common_names(root: Node) -> None:
    """Where no article or main says what the text is: class names whose outermost elements hold most of the page's
    characters are names of frames around the text. Then the names inside them are judged."""
    chars: dict[int, int] = {}
    for node in postorder(root):
        chars[id(node)] = sum(text_length(x) if isinstance(x, str) else chars.get(id(x), 0) for x in node.items)
    forgot = True
    while forgot:
        forgot, outer, stack = False, {}, [root]
        while stack:
            for x in kept(stack.pop()):
                if x.cues:
                    outer.setdefault(x.cues, []).append(x)
                else:
                    stack.append(x)
        for cues, alike in outer.items():
            if not any(c[0] == "<" and c != "<form>" for c in cues) and 2 * sum(chars[id(x)] for x in alike) > chars[id(root)]:
                forgot = True
                for x in alike:
                    x.cues = frozenset()


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_links: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of links and whose base grows with link
    characters, here and on the page (`page_links`: their share of the page)."""
    if not chars:
        return 0.0
    tags, link_tags = max(1, tags), max(1, link_tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + page_links * chars + math.e)
    return chars / tags * math.log(1.0 + max(0.0, (chars - link_chars) / max(1, link_chars)) * tags / link_tags) / (1.0 + math.log(base))


def measure(root: Node) -> list[Node]:
    """Characters, tags, link characters, link tags, density and weighted sum of every node, children first."""
    nodes = postorder(root)
    for node in nodes:
        chars = tags = link_chars = link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                chars += text_length(x)
            elif not x.skip:
                chars, tags, link_chars, link_tags = chars + x.chars, tags + x.tags + 1, link_chars + x.link_chars, link_tags + x.link_tags + (x.tag == "a")
        node.chars, node.tags, node.link_tags = chars, tags, link_tags
        node.link_chars = chars if node.tag == "a" else link_chars
    page_links = root.link_chars / max(1, root.chars)
    for node in reversed(nodes):  # parents first; what holds most of the page is no small frame beside the text
        node.weight = (node.parent.weight if node.parent else 1.0) * (CUE_WEIGHT if node.cues and 2 * node.chars <= root.chars else 1.0)
    for node in nodes:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, page_links)
        node.total = sum(x.weight * x.density for x in kept(node))
    return nodes


#: Elements that are blocks of running text or lie in one, and no region of a page.
BLOCK_OF_TEXT = frozenset("a abbr b big blockquote cite code dd dt em font h1 h2 h3 h4 h5 h6 i li mark p pre q s small span strike strong sub sup tt u".split())


def leader(nodes: list[Node]) -> Node:
    """The node of largest sum; of equal ones the outermost, then the first."""
    lead = nodes[-1]  # the root
    for node in reversed(nodes):
        if node.total > lead.total:
            lead = node
    return lead


def mostly_links(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def choose(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order, none inside another; furniture in them loses its text."""
    nodes = measure(root)
    if not root.chars:
        return []
    node = leader(nodes)
    while node.parent is not None and node.tag in BLOCK_OF_TEXT:  # a paragraph leads for what it stands in
        node = node.parent
    path = []
    while node is not None:
        path.append(node)
        node = node.parent
    whole = next((x for tag in ("article", "main") for x in path if x.tag == tag), None)
    if whole is not None:  # an article whose part leads belongs whole
        path = path[path.index(whole) :]
    threshold = min([x.density for x in path if x.tag not in PAGE], default=0.0)
    on_path = {id(x) for x in path}
    for node in nodes:
        if id(node) not in on_path and (node.cues or path[0].tag not in ("article", "main") and node.tag in CONTAINERS and node.link_tags > 2 and node.link_chars > 0.8 * node.chars):
            node.skip = True
    marked = {id(path[0])}
    for at, above in zip(path, path[1:], strict=False):
        before = True
        for x in kept(above):
            if x is at:
                before = False
            elif x.tag in ("h1", "h2") and before or whole is not None and x.tag == whole.tag and x.density >= threshold:
                marked.add(id(x))
            elif whole is None and x.chars and not mostly_links(x) and x.density >= threshold * (1.0 if above.tag in PAGE else INNER):
                marked.add(id(x))
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in marked:
            out.append(node)
        else:
            stack.extend(reversed(kept(node)))
    return out


def blocks(node: Node, out: list[str]) -> None:
    """Texts of the blocks below `node`; inline markup is part of its block."""
    run: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        at, i = stack.pop()
        if i == 0 and at.tag in BLOCK:
            close()
        while i < len(at.items):
            x = at.items[i]
            i += 1
            if isinstance(x, str):
                run.append(x)
            elif x.tag in ("br", "hr", "wbr"):
                run.append("" if x.tag == "wbr" else " ")
            elif not x.skip:
                stack.append((at, i))
                stack.append((x, 0))
                break
        else:
            if at.tag in BLOCK:
                close()
    close()


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    out: list[str] = []
    for node in choose(root):
        blocks(node, out)
    return " ".join(out)


def _texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.concat_arrays([pa.array([main_text(x) for x in part], pa.string()) for part in text_slices(pages, 64)])


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """`pages` with the main text in `text_col`."""
    ship(pages.sparkSession)
    return pages.withColumn(text_col, F.arrow_udf(_texts, "string")(F.col(html_col).cast("string")))
