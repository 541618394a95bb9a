"""Main text of web pages by site template removal.

Every element's subtree is hashed (its name, its text, its children's hashes).  Spark counts
in how many different pages of its host a subtree occurs; pages whose bodies are equal
count once, so mirrored pages do not make a template.  A subtree that occurs in at least
``MIN_PAGES`` different pages of a host of any size is template, and is deleted with all in it.
Only ``CONTAINERS`` can be
template, not paragraphs, headings, list items, rows, cells or what stands in a line: shared passages are text.  An article of
which templates leave nothing keeps its own: a text that was copied into many pages is no template.

Elements that are never article text by their meaning go as well: menus, headers, footers,
sidebars, notices, adverts, forms, comments, scripts, styles and what is hidden, told by
their names and roles, whatever share of the page they are.  A class or an id tells it for containers,
never for one that holds the first-level heading.  Inside an article a whole token must be listed
(reader comments: its last word, as in ``entry-comments``); on a page without one the token's
last word does (``site-footer``, not ``social-history`` or ``no-sidebar``).  Paragraphs, items and cells go
by a class of ``ASIDES``; headings stay.

A page is known by two hashes of its html.  Rows (page, subtree) of all containers are counted; those that stand where
text counts and that meaning leaves (a small part) are joined with what recurs and gathered to one short row a page
(not more than its elements), which the pages then look up: html is shuffled only where such rows are too many to broadcast.
What recurs is at most an eighth of those rows, so it is repeated for ``SALTS`` parts of a subtree's
pages: a menu on a third of all pages meets it in many tasks.  Pages that are copies share one key,
whose rows adaptive execution can split, as the other side is one row.

Edge cases: null html is empty; a page without text gives an empty string; a cut-off tag,
comment or script ends the page; a url without host has the empty host; very long pages are read whole, one
at a time in a task; repeated rows get a row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.url_trust import host_of
from reviewlens.session import materialize

MIN_PAGES = 8
#: Parts into which a subtree's pages are dealt for the join; not more than MIN_PAGES.
SALTS = 8
#: Elements nested deeper stand side by side, as in browsers.
DEPTH = 400

# Fixed values of HTML: elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary address".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article main header footer nav aside form fieldset ul ol dl table thead tbody tfoot tr "
    "figure details dialog menu search hr center head legend optgroup option hgroup".split()
)
CONTAINERS = frozenset(
    "div section header footer nav aside form fieldset ul ol dl table figure details dialog menu search center".split()
)
CLOSES = {  # a start tag that ends an open element, unless one of the second kind lies between
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# Fixed values of this operator: what is not article text.
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe object svg canvas math button select textarea "
    "dialog menu audio video head noembed noframes xmp title datalist search map".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status "
    "tooltip".split()
)
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos "
    "promotion sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies "
    "consent gdpr notice notices newsletter subscribe subscription signup popup modal share sharing social "
    "related recommended comment comments commentlist disqus respond replies toolbar pagination pager "
    "login copyright header banner skip alert alerts announcement disclaimer paywall".split()
)

DISCUSSION = frozenset("comment comments commentlist disqus respond replies".split())
#: What a class tells of a paragraph, an item or a cell.
ASIDES = DISCUSSION | frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos "
    "cookie cookies gdpr notice notices newsletter".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEGATED = frozenset("no has with without".split())

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z].*""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WATCHED = ("class", "id", "role", "hidden", "style")


class Node:
    __slots__ = ("tag", "attrs", "parts", "content", "mark", "title")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs = tag, attrs
        self.parts: list[Node | str] = []
        self.content = False  # holds an article or main element
        self.mark = 0  # hash of the subtree, 0 without text
        self.title = tag == "h1"  # is or holds a first-level heading


def parse(html: str) -> Node:
    """The page's element tree."""
    root = Node("html")
    stack = [root]
    at, n = 0, len(html)

    def text(a: int, b: int) -> None:
        if a < b:
            run = html[a:b]
            stack[-1].parts.append(unescape(run) if "&" in run else run)

    def pop_to(names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            # an inline end tag does not reach out of a block
            pop_to({name}, frozenset() if name in BLOCKS else BLOCKS)
            continue
        if name in BLOCKS:
            pop_to({"p"}, BLOCKS - {"p"})
        if name in CLOSES:
            pop_to(*CLOSES[name])
        node = Node(name, m[3])
        stack[-1].parts.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
        elif name not in VOID and len(stack) < DEPTH:  # <name/> opens an element, too
            stack.append(node)
            if name in ("article", "main"):
                for open_ in stack:
                    open_.content = True
            if name == "h1":
                for open_ in stack:
                    open_.title = True
    return root


def _attributes(raw: str) -> dict[str, str]:
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)}
    return {k: found[k] for k in WATCHED if k in found}


def _heading(node: Node) -> bool:
    return any(not isinstance(p, str) and (p.tag in ("h1", "h2") or _heading(p)) for p in node.parts)


def listed(attrs: dict[str, str], inside: bool) -> set[str]:
    """The words of the list that a class or id says."""
    found = set()
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in WORD.findall(token)]
        if token.lower() in WORDS:
            found.add(token.lower())
        elif words and words[-1] in (DISCUSSION if inside else WORDS) and NEGATED.isdisjoint(words):
            found.add(words[-1])
    return found


def boilerplate(node: Node, inside: bool) -> bool:
    """Whether an element of a page is no article text by its meaning; ``inside`` an article."""
    if node.tag in DROPPED:
        return True
    if node.tag == "header":
        return not (inside and _heading(node)) and not node.content
    if not node.attrs or node.tag in ("html", "body"):
        return False
    attrs = _attributes(node.attrs)
    if "hidden" in attrs or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    if _article(node):
        return not listed(attrs, True).isdisjoint(("comment", "comments", "ad", "advert", "sponsored", "advertisement"))
    if node.content or node.tag in HEADINGS or node.title:
        return False
    if node.tag in PARAGRAPHS:
        return not ASIDES.isdisjoint(attrs.get("class", "").lower().split())
    return bool(listed(attrs, inside))


def mark(node: Node) -> int:
    """Hash the subtree of every element."""
    key = [node.tag]
    some = False
    for part in node.parts:
        if isinstance(part, str):
            words = " ".join(part.split())
            if words:
                key.append("\0" + words)
                some = True
        else:
            h = mark(part)
            key.append(f"\1{h}")
            some |= h != 0
    node.mark = xxhash.xxh3_64_intdigest("".join(key)) - (1 << 63) if some else 0
    return node.mark


def _article(node: Node) -> bool:
    return node.tag in ("article", "main")


def subtrees(root: Node) -> tuple[int, dict[int, bool]]:
    """(the page's hash, the hash of each container and whether its text counts unless it is template)."""
    mark(root)
    only = root.content
    found: dict[int, bool] = {}

    def visit(node: Node, inside: bool, kept: bool) -> None:
        for part in node.parts:
            if isinstance(part, str) or not part.mark:
                continue
            stays = kept and not boilerplate(part, inside and only)
            if part.tag in CONTAINERS and not part.content:
                found[part.mark] = found.get(part.mark, False) or (stays and inside)
            visit(part, inside or _article(part), stays)

    visit(root, not only, True)
    return root.mark, found


def main_text(root: Node, templates: frozenset[int] | set[int]) -> str:
    """Blocks of the article, without templates (hashes) and boilerplate, joined by two line ends."""
    if templates:
        mark(root)
        text = _blocks(root, templates)
        if text or not root.content:
            return text
    return _blocks(root, frozenset())


def _blocks(root: Node, templates: frozenset[int] | set[int]) -> str:
    blocks: list[str] = []
    line: list[str] = []
    only = root.content  # text outside of article and main does not count

    def flush() -> None:
        words = " ".join("".join(line).split())
        if words:
            blocks.append(words)
        line.clear()

    def visit(node: Node, inside: bool) -> None:
        for part in node.parts:
            if isinstance(part, str):
                if inside:
                    line.append(part)
                continue
            if part.tag == "br":
                line.append(" ")
                continue
            block = part.tag in BLOCKS
            if block:
                flush()
            template = part.tag in CONTAINERS and part.mark in templates and not part.content
            if not template and not boilerplate(part, inside and only):
                visit(part, inside or _article(part))
            if block:
                flush()

    visit(root, not only)
    flush()
    return "\n\n".join(blocks)


KEY = ["host", "page_a", "page_b"]


def page_subtrees(pages: DataFrame) -> DataFrame:
    """``host, page_a, page_b`` as in ``pages``, with ``body`` (its hash), ``subtree`` and ``counts``, for each container of ``html``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bodies, marks, counts = [], [], [], []
            for row, html in enumerate(batch.column("html")):
                body, found = subtrees(parse(html.as_py()))
                rows += [row] * len(found)
                bodies += [body] * len(found)
                marks += found.keys()
                counts += found.values()
            keys = batch.select(KEY).take(pa.array(rows, pa.int64()))
            more = [pa.array(bodies, pa.int64()), pa.array(marks, pa.int64()), pa.array(counts, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*keys.columns, *more], [*KEY, "body", "subtree", "counts"])

    schema = "host string, page_a long, page_b long, body long, subtree long, counts boolean"
    return pages.select(*KEY, "html").mapInArrow(run, schema)


def recurring(each: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, subtree`` in at least ``min_pages`` different bodies of the host (rows ``host, subtree, body``)."""
    different = each.select("host", "subtree", "body").distinct()
    return different.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages).drop("n")


def page_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, page_a, page_b, templates``: the subtrees of a page that recur, for the pages that have any."""
    each = materialize(page_subtrees(pages), "html-subtrees")
    salts = F.array(*(F.lit(i) for i in range(SALTS)))
    found = recurring(each, min_pages).withColumn("salt", F.explode(salts))
    rows = each.filter("counts").withColumn("salt", F.pmod("page_a", F.lit(SALTS)).cast("int"))
    met = rows.join(found, ["host", "subtree", "salt"])
    return met.groupBy(*KEY).agg(F.collect_set("subtree").alias("templates"))


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("page_a", F.xxhash64("html")).withColumn("page_b", F.xxhash64(F.lit("page"), "html"))
    templates = materialize(page_templates(rows, min_pages), "html-templates")

    @F.arrow_udf("string")
    def text_of(html: pa.Array, marks: pa.Array) -> pa.Array:
        return pa.array(
            [main_text(parse(h.as_py()), set(m.as_py() or ())) for h, m in zip(html, marks)], pa.string()
        )

    joined = rows.join(templates, KEY, "left").select("page_id", "url", text_of("html", "templates").alias("text"))
    return joined.withColumn("n_chars", F.char_length("text").cast("long"))
