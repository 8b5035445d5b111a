"""Main text of web pages by composite text density.

Every node of a page's tree gets its density: characters a tag, adjusted by how much of them is link text. A node's sum
is the sum of its children's densities. The node with the greatest sum holds the content; the least density on the way
from it up to the body is the threshold, and what reaches the threshold beside that way belongs to the content too. If the
chosen node lies in an article (or main) element, the whole element is the content.

Left out wherever it stands: menus, page headers and footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments, known by element, role, or words of class and id.

A page is cut into tags and text from left to right, by a regular expression that never goes back (time grows with the page, whatever it holds): quotes
part attribute values only where HTML reads a value, a tag or comment without an end takes the rest of the page. The tags build a small
tree. Missing end tags are closed as HTML closes them: a block ends an open p, li ends li, and an end tag closes everything opened inside its
element. Elements that are left out stand on the same stack as the others and close by the same rules. What is nested deeper than MOST_DEEP
levels is read as standing side by side there, as browsers do.

A class or id marks an element if all words of one of its names are words of boilerplate and layout, one of boilerplate at least: ad-slot-2 and
siteFooter do, search-engine and related-work don't. Plurals count as their singulars, and names that advert services give their boxes (adsbygoogle) as adverts. Of an article's header its headings,
divisions and paragraphs (a lead) belong to the text, loose bylines and dates don't; other headers are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_in_small_batches

WHITE = r" \t\n\f\r"
NAME = rf"[^{WHITE}/>][^{WHITE}/>=]*+"
EQUALS = rf"[{WHITE}]*+=[{WHITE}]*+"
UNQUOTED = rf"[^{WHITE}>\"'][^{WHITE}>]*+"
#: White space, or a name with its value; a value that begins with a quote must end with it.
IN_TAG = rf"""[{WHITE}/]++|{NAME}(?:{EQUALS}(?:"[^"]*+"|'[^']*+'|{UNQUOTED}|(?=>))|(?!{EQUALS}))"""
#: A comment, what HTML reads as one, a tag (groups: end tag, name, attributes), or a tag that doesn't end.
TAG = re.compile(rf"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?:[!?]|/(?![a-zA-Z>]))[^>]*+(?:>|\Z)|/>|(/?+)([a-zA-Z][^{WHITE}/>]*+)((?:{IN_TAG})*+)>|/?[a-zA-Z].*)", re.S)
ATTRIBUTE = re.compile(rf"""({NAME})(?:{EQUALS}(?:"([^"]*+)"|'([^']*+)'|({UNQUOTED})?))?+""")
SPACE = re.compile(r"\s+")
MOST_DEEP = 512

# Element names of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
RAW_ENDS = {name: re.compile(rf"</{name}(?=[{WHITE}/>])", re.I) for name in RAW}
DROPPED = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "title", "head", "menu", "dialog", "button", "select", "option", "textarea", "svg", "canvas", "object", "audio", "video", "xmp"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OF_A_HEADER = HEADINGS | {"div", "hgroup", "p"}
BLOCKS = HEADINGS | {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
ENDS_ITS_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th", "caption"}, "td": {"td", "th", "caption"}, "th": {"td", "th", "caption"},
    **dict.fromkeys(("tbody", "thead", "tfoot"), {"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}),
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "rt": {"rt", "rp"}, "rp": {"rt", "rp"}, "a": {"a"}, "button": {"button"},
}
ENDS_P = BLOCKS | {"dialog", "hgroup", "menu"}
IN_HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
TABLE_PARTS = {"caption", "table", "tbody", "td", "tfoot", "th", "thead", "tr"}
CELLS = {"caption", "object", "table", "td", "th"}
#: What an inline end tag inside of a left-out element doesn't look beyond.
SPECIAL = ENDS_P | {"button", "object", "ruby", "select"}
#: What ENDS_ITS_LIKE doesn't look beyond, outside of tables.
STOPS = SPECIAL - {"address", "div", "p"}
SCOPES = {"ul", "ol", "dl", "table", "body", "article", "section", "div", "main"}

#: Words of class, id or role that mark what isn't the article.
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "hidden", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "popup", "promo", "promoted", "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}

#: Words that say where or what kind of a box an element is.
LAYOUT = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "center", "col", "column", "container", "content", "count", "desktop", "entry", "fb", "field", "fixed", "form",
    "global", "group", "header", "heading", "icon", "icons", "inner", "input", "is", "item", "items", "js", "large", "left", "link", "links", "list", "main", "message", "mobile", "module", "more", "outer", "overlay",
    "page", "panel", "policy", "post", "posts", "primary", "reader", "readers", "region", "reply", "right", "row", "secondary", "section", "site", "slot", "small", "stories", "sticky", "text", "thread", "title", "toggle",
    "top", "unit", "user", "wrap", "wrapper", "zone",
}
#: A class that begins so tells of the layout (no-sidebar, has-comments), not of the element's own content.
ABOUT_LAYOUT = {"no", "has", "with", "without"}
#: Words that begin so are names of advert services' boxes.
ADVERTS = ("adsby", "adslot", "adunit", "adcontainer", "adwrap")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Node:
    __slots__ = ("name", "children", "chars", "link_chars", "tags", "link_tags", "density", "total", "skipped")

    def __init__(self, name: str, skipped: bool = False):
        self.name, self.children, self.skipped = name, [], skipped
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def marked(name: str, attributes: str, in_article: bool) -> bool:
    if name in DROPPED:
        return True
    if name == "header" and not in_article:
        return True
    if attributes and name not in ("html", "body", "article", "main"):
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return True
            if key in ("class", "id", "role") and any(names_boilerplate(one, in_article) for one in value.split()):
                return True
    return False


def _known(word: str) -> str:
    """A word as the lists have it: plurals by their singular, names of advert boxes as an advert."""
    if word.startswith(ADVERTS):
        return "advert"
    if word.endswith("s") and word not in BOILERPLATE and word not in LAYOUT and (word[:-1] in BOILERPLATE or word[:-1] in LAYOUT):
        return word[:-1]
    return word


@lru_cache(maxsize=4096)
def names_boilerplate(name: str, in_article: bool) -> bool:
    words = [_known(w.lower()) for w in WORDS.findall(name)]
    if not words or words[0] in ABOUT_LAYOUT:
        return False
    some = not BOILERPLATE.isdisjoint(words) or "header" in words and not in_article
    return some and all(w in BOILERPLATE or w in LAYOUT or w.isdigit() for w in words)


def parse(page: str) -> Node:
    """The tree of what may be content; marked elements are left out while it is built."""
    root = Node("body")
    stack, at = [root], 0
    within: Counter[str] = Counter()  # open elements by name, those left out too
    page = page.replace("\0", "")
    while True:
        m = TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if stack[-1].name == "head" and not (text.isspace() or not text):
            close(stack, within, len(stack) - 1)
        if text and not stack[-1].skipped:
            stack[-1].children.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "br":
                if not stack[-1].skipped:
                    stack[-1].children.append(" ")
            elif k := ended(stack, within, name):
                close(stack, within, k)
            continue
        if stack[-1].name == "head" and name not in IN_HEAD:
            close(stack, within, len(stack) - 1)
        if name in RAW:
            end = RAW_ENDS[name].search(page, at)
            at = TAG.match(page, end.start()).end() if end else len(page)
            continue
        if name in ("html", "body"):
            continue
        if name in ENDS_P:
            close_paragraph(stack, within)
        if name in ENDS_ITS_LIKE and (k := ended_by_like(stack, within, name)):
            close(stack, within, k)
        if name in HEADINGS and stack[-1].name in HEADINGS:
            close(stack, within, len(stack) - 1)
        # What is left out depends on what is still open now.
        skipped = stack[-1].skipped or marked(name, m[3] or "", bool(within["article"] or within["main"]))
        if name in VOID or (m[3] or "").endswith("/") and name not in BLOCKS:
            if name in ("br", "hr") and not skipped:
                stack[-1].children.append(Node("hr") if name == "hr" else " ")
            continue
        if len(stack) > MOST_DEEP:
            close(stack, within, len(stack) - 1)
        node = Node(name, skipped)
        if not skipped:
            stack[-1].children.append(node)
        stack.append(node)
        within[name] += 1


def ended(stack: list[Node], within: Counter[str], name: str) -> int:
    """The place of the open element that an end tag closes; 0 for none. A heading's end tag closes any heading."""
    like = HEADINGS if name in HEADINGS else (name,)
    for k in range(len(stack) - 1, 0, -1) if any(within[x] for x in like) else ():
        node = stack[k]
        if node.name in like:
            return k
        if node.name in ({"table"} if name in TABLE_PARTS else CELLS) or node.skipped and name not in ENDS_P and node.name in SPECIAL:
            return 0
    return 0


def ended_by_like(stack: list[Node], within: Counter[str], name: str) -> int:
    """The place of the outermost open element that a start tag ends within its list or table; 0 for none."""
    like, stops, found = ENDS_ITS_LIKE[name], {"table"} if name in TABLE_PARTS else STOPS, 0
    for k in range(len(stack) - 1, 0, -1) if any(within[x] for x in like) else ():
        if stack[k].name in like:
            found = k
        elif stack[k].name in stops:
            break
    return found


def close(stack: list[Node], within: Counter[str], k: int) -> None:
    """Closes the k-th open element and all inside it."""
    within.subtract(n.name for n in stack[k:])
    del stack[k:]


def close_paragraph(stack: list[Node], within: Counter[str]) -> None:
    for k in range(len(stack) - 1, 0, -1) if within["p"] else ():
        if stack[k].name == "p":
            close(stack, within, k)
            return
        if stack[k].name in SCOPES:
            return


def in_order(root: Node) -> list[Node]:
    """All nodes, each before what it holds; deep trees need no recursion."""
    out, rest = [], [root]
    while rest:
        node = rest.pop()
        out.append(node)
        rest.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def measure(nodes: list[Node]) -> None:
    """Densities: characters a tag times a logarithm whose base falls with the share of link text."""
    for node in reversed(nodes):
        for c in node.children:
            if isinstance(c, Node):
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.name == "a")
            else:
                node.chars += len(SPACE.sub(" ", c).strip())
        if node.name == "a":
            node.link_chars = node.chars
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            node.density = c / t * max(0.0, math.log(max(1e-9, c / max(1, lc) * t / lt)) / base)
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))


def content(root: Node) -> list[Node]:
    """The chosen nodes, in page order."""
    nodes = in_order(root)
    measure(nodes)
    best = max(nodes, key=lambda n: n.total)  # the first in page order on ties
    parent = {id(c): n for n in nodes for c in n.children if isinstance(c, Node)}
    way = [best]
    while id(way[-1]) in parent:
        way.append(parent[id(way[-1])])
    if whole := [n for n in way if n.name in ("article", "main")]:
        return [whole[-1]]
    threshold = min((n.density for n in way if n.density > 0), default=0.0)
    inner = {id(n) for n in way[1:]}

    if best is root:
        return [root]
    out, rest = [], [root]
    while rest:
        node = rest.pop()
        if id(node) in inner:
            rest.extend(c for c in reversed(node.children) if isinstance(c, Node))
        elif node is best or node.density >= threshold or node.name in HEADINGS and node.chars:
            out.append(node)
    return out


def blocks(nodes: list[Node]) -> list[str]:
    """The text of each block in page order, white space as one space."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if line := SPACE.sub(" ", "".join(held)).strip():
            out.append(line)
        held.clear()

    for top in nodes:
        rest: list[Node | str | None] = [top]
        while rest:
            x = rest.pop()
            if isinstance(x, Node):
                if block := x.name in BLOCKS:
                    flush()
                    rest.append(None)
                inner = x.children if x.name != "header" else [c for c in x.children if isinstance(c, Node) and c.name in OF_A_HEADER]
                rest.extend(reversed(inner))
                if block and not x.children:
                    flush()
            elif x is None:
                flush()
            else:
                held.append(x)
        flush()
    return out


def main_text(page: str | None) -> str:
    """The article's text, one line for each block; empty for a null or empty page or one without text."""
    return "\n".join(blocks(content(parse(page)))) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page, from the whole html.

    Out: id_col, url_col, text string, n_chars long (code points). Null or empty html and pages without content give an empty
    text with 0 characters. One row out for each row in, repeated or not; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "link", "text", "n_chars"])

    texts_in_small_batches(pages.sparkSession)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("link"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kinds[0]}, link {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "link": url_col})
