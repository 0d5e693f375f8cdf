"""Main text of web pages: site templates are found by counting element subtrees per host.

1. Every page is parsed in its task. The subtrees of its container elements (menus, boxes, lists, tables …)
   are hashed bottom-up over tags and text.
2. Spark counts, per host and subtree, on how many different page bodies it stands. Copies of one page count
   once, so an article that is published often is no template.
3. Subtrees found on many pages of their host go. Paragraphs, headings and other prose blocks are never
   counted alone: prose that several articles share stays.
4. What remains of the article loses what its element or its class names say is no article text.

Pages are parsed again where their text is made; only hashes are shuffled for the count, and only pages whose
article holds a container that might be a template pass through a join.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyspan.session import materialise

# Element names of HTML and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
CLOSED_BY_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
NOT_TEXT = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input math menu nav noembed noframes noscript"
    " object script select style svg template textarea title video xmp".split()
)
CONTAINERS = frozenset("aside center dir div dl fieldset figure footer form header menu nav ol section table ul".split())
PROSE = frozenset(
    "a abbr b bdi bdo big blockquote cite code data dd del dfn dt em figcaption font h1 h2 h3 h4 h5 h6 i ins kbd label li mark p pre q s samp"
    " small span strike strong sub summary sup td th time tr tt u var".split()
)
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
NO_ARTICLE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NO_ARTICLE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie"
    " cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification popup"
    " promo promotion related respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that mark such names by how they begin ("cookiebar", "commentList", "advertising").
NO_ARTICLE_STARTS = ("advert", "breadcrumb", "comment", "cookie", "navbar", "newsletter", "sidebar", "sponsor")

_COMMENT = re.compile(r"<!--(?:>|->)|<!--.*?(?:--!?>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>")
_OTHER = re.compile(r"<[!?/][^>]*+>?")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass(eq=False)
class Node:
    tag: str
    attributes: str = ""
    parent: Node | None = None
    children: list = field(default_factory=list)
    key: int = 0  # hash of the subtree
    full: bool = False  # it holds text
    whole: bool = False  # an article or main element stands in it
    main: bool = False  # a main element stands in it


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def parse(page: str) -> Node:
    """The element tree: forgiving about missing end tags, as browsers are. A tag cut off by the end is dropped."""
    root = at = Node("")
    pos, size = 0, len(page)

    def text(a: int, b: int) -> None:
        if b > a:
            at.children.append(html.unescape(page[a:b]))

    while pos < size:
        lt = page.find("<", pos)
        if lt < 0:
            text(pos, size)
            break
        if page.startswith("<!--", lt):
            text(pos, lt)
            pos = _COMMENT.match(page, lt).end()
            continue
        tag = _TAG.match(page, lt)
        if tag is None:
            nxt = page[lt + 1 : lt + 2]
            if nxt.isalpha() and nxt.isascii():  # cut off by the end
                text(pos, lt)
                break
            other = _OTHER.match(page, lt)
            if other is None:
                text(pos, lt + 1)
                pos = lt + 1
            else:
                text(pos, lt)
                pos = other.end()
            continue
        text(pos, lt)
        pos = tag.end()
        name = tag[2].lower()
        if tag[1]:
            up = at
            while up is not None and up.tag != name:
                up = up.parent
            if up is not None and up.parent is not None:
                at = up.parent
            continue
        if name in CLOSES_P:
            up = at
            while up.parent is not None and up.tag not in ("p", "td", "th", "caption", "button"):
                up = up.parent
            if up.tag == "p":
                at = up.parent
        if name in CLOSED_BY_SAME:
            same, limit = CLOSED_BY_SAME[name]
            up, last = at, None
            while up.parent is not None and up.tag not in limit:
                last = up if up.tag in same else last
                up = up.parent
            if last is not None:
                at = last.parent
        node = Node(name, tag[3], at)
        at.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, pos)
            stop = end.start() if end else size
            if name == "title":
                node.children.append(page[pos:stop])
            close = page.find(">", stop) if end else -1
            pos = close + 1 if close >= 0 else size
        elif name not in VOID and not tag[3].endswith("/"):
            at = node
        elif name not in VOID and name not in ("svg", "math", "path"):
            at = node  # a slash closes no HTML element
    return root


def _walk(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out.extend(c for c in node.children if not isinstance(c, str))
    return out


def mark(root: Node) -> list[Node]:
    """Fill in the subtree hashes, bottom-up; returns the nodes, parents first."""
    nodes = _walk(root)
    for node in reversed(nodes):
        parts = [node.tag]
        for c in node.children:
            if isinstance(c, str):
                words = " ".join(c.split())
                node.full |= bool(words)
                parts.append("'" + words)
            else:
                node.full |= c.full
                node.whole |= c.whole or c.tag in ("article", "main")
                node.main |= c.main or c.tag == "main"
                parts.append(f"<{c.key:x}")
        node.key = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) >> 1
    return nodes


def is_template_shaped(node: Node) -> bool:
    return node.tag in CONTAINERS and node.full and not node.whole


def no_article(node: Node, names: bool = True, inside: bool = False) -> bool:
    """By its element, role, class or id the node holds no article text; without ``names`` class and id don't count.

    ``inside`` an article, ids of headings and sections are made from their titles and tell nothing, and classes and ids
    of inline elements, paragraphs, list items and other prose blocks are about style: only containers have such names.
    """
    if node.tag in NOT_TEXT:
        return True
    if node.attributes and node.tag not in ("html", "body", "main") and _TELLING.search(node.attributes):
        names = names and not (inside and node.tag in PROSE)
        for name, *value in _ATTRIBUTE.findall(node.attributes):
            name, value = name.lower(), html.unescape("".join(value))
            if name == "hidden":
                return True
            if name not in ("class", "id", "role"):
                continue
            if name == "role":
                if value.lower() in NO_ARTICLE_ROLES:
                    return True
            elif not names or (name == "id" and node.tag in TITLED and inside):
                continue
            elif any(w in NO_ARTICLE_NAMES or w.startswith(NO_ARTICLE_STARTS) for w in (x.lower() for x in _NAME.findall(value))):
                return True
    return False


def article_roots(root: Node) -> list[Node]:
    """The outermost article elements, else main elements, else articles in what its name says is none, else the page.

    Layout wrappers are named after what is beside the article ("has-sidebar"), so a name never hides a main
    element, nor the only articles of a page.
    """
    for tag, names in (("article", True), ("main", True), ("article", False)):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag == tag and node.full:
                found.append(node)
                continue
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str) and not no_article(c, not c.main if names else not c.whole))
        if found:
            return found
    return [root]


def blocks(root: Node) -> list[tuple[str, tuple[int, ...]]]:
    """Article text by block, each with the hashes of the template-shaped containers that it stands in."""
    out, words = [], []

    def flush(within):
        line = " ".join("".join(words).split())
        words.clear()
        if line:
            out.append((line, within))

    for top in article_roots(root):
        # in an article, articles under such a name are comments or other articles; elsewhere they may be the text
        article, inside = top.tag == "article", top.tag in ("article", "main")
        stack = [(top, (), False)]
        while stack:
            node, within, leaving = stack.pop()
            if isinstance(node, str):
                words.append(node)
            elif leaving:
                flush(within)
            elif node.tag == "br":
                words.append(" ")
            elif not no_article(node, article or not node.whole, inside) or node is top:
                block = node.tag in BLOCK or node is top
                if block:
                    flush(within)
                inner = (*within, node.key) if is_template_shaped(node) and node is not top else within
                if block:
                    stack.append((node, inner, True))
                stack.extend((c, inner, False) for c in reversed(node.children))
    return out


def _rows(batch):
    return zip(range(batch.num_rows), batch.column(1).to_pylist(), batch.column(2).fill_null("").to_pylist())


def _subtrees(batches):
    """(host, subtree, body) of every template-shaped container; body identifies the page's own text."""
    for batch in batches:
        found = set()
        for _, url, page in _rows(batch):
            host = host_of(url)
            if not host:
                continue
            root = parse(page)
            nodes = mark(root)
            body = xxhash.xxh64_intdigest("\n".join(t for t, _ in blocks(root)).encode("utf-8", "surrogatepass")) >> 1
            found.update((host, n.key, body) for n in nodes if is_template_shaped(n))
        host, key, body = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_pydict({"host": pa.array(host, pa.string()), "subtree": pa.array(key, pa.int64()), "body": pa.array(body, pa.int64())})


def _texts(boxed: bool):
    """Texts of the pages whose article holds template-shaped containers, or of all other pages."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                keep, hosts, lines, within = [], [], [], []
                for i, url, page in _rows(part):
                    root = parse(page)
                    mark(root)
                    found = blocks(root)
                    host = host_of(url)
                    if (bool(host) and any(w for _, w in found)) == boxed:
                        keep.append(i)
                        hosts.append(host)
                        lines.append([t for t, _ in found] if boxed else "\n".join(t for t, _ in found))
                        within.append([list(w) for _, w in found])
                ids = part.select(["page_id", "url"]).take(pa.array(keep, pa.int64()))
                if boxed:
                    yield pa.RecordBatch.from_arrays(
                        [*ids.columns, pa.array(hosts, pa.string()), pa.array(lines, pa.list_(pa.string())), pa.array(within, pa.list_(pa.list_(pa.int64())))],
                        ["page_id", "url", "host", "lines", "within"],
                    )
                else:
                    yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(lines, pa.string())], ["page_id", "url", "text"])

    return run


def templates(pages: DataFrame, min_pages: int = 8) -> DataFrame:
    """(host, subtree, bodies): subtrees on at least so many different pages of their host, however large it is.

    A template of one section of the host is one of the host, as its pages count there too.
    """
    seen = pages.select("page_id", "url", "html").mapInArrow(_subtrees, "host string, subtree long, body long").distinct()
    return seen.groupBy("host", "subtree").agg(F.count("*").alias("bodies")).where(F.col("bodies") >= min_pages)


def extract(pages: DataFrame, min_pages: int = 8) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html; others are left out).

    Blocks are joined by one newline; white space inside a block is one space. A null or empty page, or one
    without article text, has an empty text. A page whose url names no host is parsed like others but has no
    templates. Repeated rows each give a row.
    """
    page_id = pages.schema["page_id"].dataType.simpleString()
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    plain = pages.mapInArrow(_texts(False), f"page_id {page_id}, url string, text string")
    boxed = materialise(
        pages.mapInArrow(_texts(True), f"page_id {page_id}, url string, host string, lines array<string>, within array<array<long>>")
        .withColumn("row", F.monotonically_increasing_id()),
        "boxed",
    )
    inside = boxed.select("row", "host", F.explode(F.array_distinct(F.flatten("within"))).alias("subtree"))
    gone = inside.join(templates(pages, min_pages), ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("gone"))
    kept = boxed.join(gone, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<long>")))
    lines = F.filter(F.arrays_zip("lines", "within"), lambda b: ~F.arrays_overlap(b["within"], F.col("gone")))
    kept = kept.select("page_id", "url", F.array_join(F.transform(lines, lambda b: b["lines"]), "\n").alias("text"))
    return plain.unionByName(kept).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
