"""Main text of web pages by composite text density.

A page becomes a small tree. Every node has its characters C and tags T below it, and of these those inside links, LC and
LT. Its density is characters per tag, adjusted for links:

    density = C/T * log(C * T / (LC * LT)) to the base ln(C/nLC * LC + LCb/Cb * C + e)

with nLC = C - LC and b the body. A node's density sum is the sum of its children's densities. The subtree with the largest
sum holds the article, which is all of the <article> or <main> around it, or of the parents that hold text of the article
only. The least density on the path up to the body is the threshold: headings, paragraphs, lists and quotes beside that path
are content too, and parts made of these that reach it, are sections or have a heading. Headers, menus and the like are
dropped by their elements and roles before that, since a page with a short article can have longer notices than text.
Names of class and id are less certain: what they call junk is dropped unless it is measured to hold the article.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
NOT_TEXT = {
    "head", "script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "embed", "audio", "video",
    "nav", "footer", "aside", "form", "button", "select", "input", "textarea", "label", "option", "menu", "dialog", "title",
    "search", "xmp", "noembed", "noframes",
}
ENDS_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}}
LIST_OF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "option": {"select"}}
CONTAINERS = {"article", "body", "div", "main", "section", "td"}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
TEXT = HEADINGS | {"p", "blockquote", "pre", "ul", "ol", "dl", "table", "figure", "details"}
# Words of class and id names, and of roles, that mark what isn't the article.
BOXES = (r"ad|ads|advert\w*|promo\w*|sponsor\w*|cookie\w*|consent|gdpr|notice|newsletter|comment\w*|reply|replies|disqus|"
         r"related|recommended|responses?|paywall")  # such boxes can have long texts of their own
LAYOUT = (r"banner|popup|modal|subscribe|sidebar|widget|menu|nav|navbar|navigation|breadcrumb\w*|footer|header|masthead|"
          r"social|share|sharing|login|signup|search|complementary|contentinfo|dialog|alert")
ROLES = re.compile(rf"{BOXES}|{LAYOUT}")
OWN_TEXT = re.compile(BOXES)
REPLIES = re.compile(r"comment\w*|reply|replies|responses?|disqus|discussion")
TEASERS = re.compile(r"you-(?:may|might)-(?:also-)?like|also-like|read-(?:more|next)|more-(?:stories|articles|news)")
NEGATIONS = {"has", "have", "no", "non", "not", "with", "without"}
HEADERS = {"header", "masthead"}

TOKEN = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",  # a tag with an open quote: skipped
    re.DOTALL)
# One attribute after the other, so that words in a value are never taken for a name.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


class Node:
    """An element: its children in order, texts among them; totals are filled in by ``measure``."""

    __slots__ = ("tag", "parent", "parts", "junk", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, junk: bool = False, named: str = ""):
        self.tag, self.parent, self.junk, self.named = tag, parent, junk, named
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def is_junk(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element, its role or its being hidden says that it's not the article."""
    if tag in NOT_TEXT or tag == "header" and not inside_article:
        return True
    if not attributes or tag in {"body", "html"} | ARTICLE:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name not in ("hidden", "aria-hidden", "style", "role"):
            continue
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and any(ROLES.fullmatch(word) for word in re.split(r"[\s_-]+", value)):
            return True
    return False


def is_named(tag: str, attributes: str, inside_article: bool, in_article: bool = False) -> str:
    """What class and id say: "" nothing, "junk", or "wrapper" if the word only describes a part of the layout (search-page).

    An id is an anchor as often as a role: that of a heading, paragraph, list or section says nothing, unless it names
    reader comments outside of an <article>. The class of a heading or paragraph counts as a whole only (ad, not ad-hoc).
    An <article> in the article is a part of it or a reader's comment, and only the latter's names count.
    """
    found = ""
    if not attributes or tag in {"body", "html"} or tag in ARTICLE and not inside_article:
        return found
    for attribute, value in ATTRIBUTE.findall(attributes):
        attribute = attribute.lower()
        if attribute not in ("class", "id"):
            continue
        for name in value.strip("\"'").lower().replace("side-bar", "sidebar").split():
            words = [word for word in re.split(r"[_-]+", name) if word]
            if tag in ARTICLE:
                if words and (REPLIES.fullmatch(words[0]) or REPLIES.fullmatch(words[-1])):
                    return "junk"
                continue
            if attribute == "id" and (tag in TEXT or tag == "section"):
                if tag == "section" and not in_article and REPLIES.fullmatch(name):
                    return "junk"
                continue
            if TEASERS.fullmatch("-".join(words)):
                return "junk"
            if tag in HEADINGS or tag == "p":
                if ROLES.fullmatch(name) and not HEADERS.issuperset({name}):
                    return "junk"
                continue
            negated = next((i for i, word in enumerate(words) if word in NEGATIONS), len(words))
            marks = [word for word, after in zip(words[:negated], [*words[1:], ""]) if ROLES.fullmatch(word) and after != "free"]
            if not marks or HEADERS.issuperset(marks) and (inside_article or words[0] in ("article", "entry", "post", "story")):
                continue
            if ROLES.fullmatch(words[-1]) or negated < len(words) or any(map(OWN_TEXT.fullmatch, marks)):
                return "junk"
            found = "wrapper"
    return found


def tree(page: str) -> Node:
    """The body of a page. Broken markup gives some tree: unknown ends are skipped, open elements end with the page."""
    root = node = Node("body", None)
    depth_article, at = 0, 0
    stack = {"body": 1}
    for match in TOKEN.finditer(page):
        start = match.start()
        if start < at:  # inside a raw element that has been skipped
            continue
        if start > at:
            node.parts.append(page[at:start])
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag in ("html", "body") or not stack.get(tag):
                continue
            while node.tag != tag:
                stack[node.tag] -= 1
                depth_article -= node.tag in ARTICLE
                node = node.parent
            stack[tag] -= 1
            depth_article -= tag in ARTICLE
            node = node.parent or root
            continue
        if tag in ("html", "body"):
            while tag == "body" and stack.get("head"):  # a head that isn't ended ends here
                stack[node.tag] -= 1
                node = node.parent
            continue
        if tag in ENDS_P and node.tag in ("p", "b", "i", "em", "strong", "span", "a", "u", "small", "font") and stack.get("p"):
            # a block ends an open paragraph and what is open in it
            open_node = node
            while open_node.tag not in BLOCK:
                open_node = open_node.parent
            if open_node.tag == "p":
                while node is not open_node:
                    stack[node.tag] -= 1
                    node = node.parent
                stack["p"] -= 1
                node = node.parent
        elif tag in ENDS_SAME and any(stack.get(x) for x in ENDS_SAME[tag]):
            open_node = node
            while open_node.parent and open_node.tag not in ENDS_SAME[tag] and open_node.tag not in LIST_OF[tag]:
                open_node = open_node.parent
            if open_node.tag in ENDS_SAME[tag]:
                while node is not open_node.parent:
                    stack[node.tag] -= 1
                    node = node.parent
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        inside = depth_article > 0
        made = Node(tag, node, is_junk(tag, match[3], inside), is_named(tag, match[3], inside, stack.get("article", 0) > 0))
        node.parts.append(made)
        if tag not in VOID and not match[3].endswith("/"):
            node = made
            stack[tag] = stack.get(tag, 0) + 1
            depth_article += tag in ARTICLE
    if at < len(page):
        node.parts.append(page[at:])
    return root


def measure(body: Node) -> list[Node]:
    """Fill in the totals of every node without recursion; the nodes in page order, junk left out."""
    order, todo = [], [(body, False)]
    linked: dict[int, bool] = {}
    while todo:
        node, in_link = todo.pop()
        order.append(node)
        in_link = in_link or node.tag == "a"
        linked[id(node)] = in_link
        todo += [(part, in_link) for part in reversed(node.parts) if isinstance(part, Node) and not part.junk]
    for node in reversed(order):
        own = sum(sum(map(len, part.split())) for part in node.parts if isinstance(part, str))
        node.chars += own
        if linked[id(node)]:
            node.link_chars += own
        if node.parent is not None and node is not body:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a")
    for node in order:
        node.density = density(node, body)
        if node is not body:
            node.parent.total += node.density
    return order


def settle_names(body: Node) -> None:
    """Make junk of what class and id call so, but not of what holds the densest subtree as its article.

    A box with long text of its own isn't that if an article stands outside: text of an <article> or <main>, or paragraphs,
    unless the only headline is in the box. For a part of the layout only an <article> or <main> beside it counts.
    """
    order, todo = [], [(body, False, False, False, False)]
    prose = headline = False
    clean: dict[int, int] = {}  # text outside of named elements, links and headings
    marked: set[int] = set()  # elements with an article or headline in them
    while todo:
        node, under, in_text, in_heading, in_link = todo.pop()
        order.append(node)
        under, in_link = under or bool(node.named), in_link or node.tag == "a"
        in_heading, in_text = in_heading or node.tag in HEADINGS, in_text or node.tag in TEXT
        own = any(isinstance(part, str) and not part.isspace() for part in node.parts)
        clean[id(node)] = int(own and not (under or in_heading or in_link))
        prose |= in_text and clean[id(node)] > 0
        headline |= own and not under and node.tag == "h1"
        if node.tag == "h1" or node.tag in ARTICLE:
            marked.add(id(node))
        todo += [(part, under, in_text, in_heading, in_link) for part in reversed(node.parts) if isinstance(part, Node) and not part.junk]
    if not any(node.named for node in order):
        return
    for node in reversed(order[1:]):
        clean[id(node.parent)] += clean[id(node)]
        if id(node) in marked:
            marked.add(id(node.parent))
    around = {id(body): 0}  # articles with clean text from the body down to the node
    for node in order[1:]:
        around[id(node)] = around[id(node.parent)] + (node.tag in ARTICLE and clean[id(node)] > 0)
    articles = sum(node.tag in ARTICLE and clean[id(node)] > 0 for node in order)
    asked = []
    for node in order:
        if node.named == "wrapper" and articles == around[id(node)] or node.named == "junk" and not articles and (
                not prose or id(node) in marked and not headline):
            asked.append(node)
        elif node.named:
            node.junk = True
    if not asked:
        return
    held = measure(body)
    best = max(held, key=lambda node: node.total)
    holds = {id(node) for node in (best, *ancestors(best))}
    while inner := [part for part in best.parts if isinstance(part, Node) and not part.junk and part.chars]:
        best = max(inner, key=lambda part: part.density)
        holds.add(id(best))
    for node in asked:
        node.junk = id(node) not in holds
    for node in held:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0


def density(node: Node, body: Node) -> float:
    if not node.chars:
        return 0.0
    c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body.link_chars / max(body.chars, 1) * c + math.e)
    return c / t * math.log(max(c * t / (lc * lt), 1.0)) / math.log(max(base, 1.0) + 1.0)


def content_roots(body: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    settle_names(body)
    order = measure(body)
    best = max(order, key=lambda node: node.total)  # the first of equals
    path = [best, *ancestors(best)]
    threshold = min(node.density for node in path)
    root = best
    while root.parent is not None and root.tag not in CONTAINERS:
        root = root.parent  # paragraphs beside the densest one belong to the same article
    named = [node for node in path if node.tag in ARTICLE]
    if named:
        root = named[-1]
    while root.parent is not None and all(belongs(part, threshold, root.parent is body) for part in beside(root)):
        root = root.parent  # nothing but the article in it
    roots, at = [root], root
    while at.parent is not None:
        roots += [part for part in beside(at) if belongs(part, threshold, True)]
        at = at.parent
    marked = {id(node) for node in roots}
    return [node for node in order if id(node) in marked]


def beside(node: Node) -> list[Node]:
    """The other elements with text of a node's parent."""
    return [part for part in node.parent.parts if isinstance(part, Node) and part is not node and not part.junk and part.chars]


def belongs(node: Node, threshold: float, strict: bool) -> bool:
    """Whether what stands beside the article is text of it: a heading, paragraph, list or quote, or a part made of these.

    A strict answer is for places where notices stand too: a plain part must also be dense or have a heading.
    """
    if node.link_chars * 3 >= node.chars:
        return False
    if node.tag in TEXT:
        return True
    inside, heading, todo = 0, False, [node]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, Node) and not part.junk:
                if part.tag in TEXT:
                    inside += part.chars
                    heading |= part.tag in HEADINGS
                else:
                    todo.append(part)
    return 2 * inside >= node.chars and (not strict or heading or node.tag in ("article", "section") or node.density >= threshold)


def ancestors(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def blocks(root: Node) -> Iterator[str]:
    """The texts between block boundaries, white space made single, character references decoded."""
    held: list[str] = []
    todo: list[Node | str | None] = [root]
    while todo:
        part = todo.pop()
        if part is None or isinstance(part, Node) and part.tag in BLOCK:
            text = " ".join(html.unescape("".join(held)).split())
            held = []
            if text:
                yield text
        if isinstance(part, str):
            held.append(part)
        elif part is not None and not part.junk:
            todo += [None] if part.tag in BLOCK else []
            todo += reversed(part.parts)
    text = " ".join(html.unescape("".join(held)).split())
    if text:
        yield text


def main_text(page: str | None) -> str:
    """Blocks of the article joined by a line end; empty for null, empty and text-free pages."""
    if not page:
        return ""
    return "\n".join(block for root in content_roots(tree(page)) for block in blocks(root))


@F.pandas_udf(T.StringType())
def extract(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract_main_text(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """All columns and ``out`` (replaced if there): the main text, "" for a null page. Rows are independent, so repeated rows agree."""
    return pages.withColumn(out, extract(F.col(html_column)))


def op2_main_text(pages: DataFrame) -> DataFrame:
    found = extract_main_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
