"""Main text of web pages by tree scoring.

A tolerant parser builds the tree of a page.  Each paragraph gives points for its length and its
commas, less its share of linked text, to its parent, half of them to its grandparent and a quarter to
the next; a container's points are discounted by its share of linked text.  The best container is kept
with those siblings, its own and those of the boxes around it, that score well beside it.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left
out before, by tag, role and class names.  A name alone is no proof: a container that holds most of the
text of a page without a marked article, or its first heading, stays, and flags of a page's layout
("has-sidebar", "no-comments") are not names of furniture.

Time is linear in the page: tokens are read once, sums are taken bottom-up, and elements below a depth
of 500 are read as children of that depth.

Defined cases: a null or empty page has an empty text; markup that is not closed ends with its parent;
a page without any tag is one block; rows that repeat an id are extracted each.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W

#: tags whose content is never text
RAW = frozenset(["script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select", "object"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
#: tags that are page furniture
OUT = frozenset(["nav", "footer", "aside", "form", "button", "dialog", "menu", "head"])
BLOCK = frozenset(
    ["html", "body", "main", "article", "section", "div", "header", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "hr", "center", "fieldset"]
    + sorted(OUT)
)
#: an open p ends where one of these begins
ENDS_P = BLOCK - {"html", "body"}
#: what an element closes when it begins within the nearest of the second set
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
BAD_NAME = re.compile(r"(?<![a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|menu\w*|nav\w*|breadcrumb\w*|sidebar\w*|side-bar|footer\w*|masthead|cookie\w*|consent\w*|notice\w*|popup|modal|overlay|subscri\w*|newsletter\w*|signup|login|share\w*|sharing|social\w*|related\w*|recommend\w*|pagination|pager|toolbar|widget\w*|alert\w*|gdpr|skip-link)(?![a-z])", re.I)
COMMENT_NAME = re.compile(r"(?<![a-z])(?:comments?|commentlist|comment-?(?:list|section|thread|area)|disqus\w*|repl(?:y|ies)|respond)(?![a-z])", re.I)
#: names that say how a page is laid out, not what a box is
FLAG = re.compile(r"(?:has|have|no|not|non|with|without|is|show|hide|js|enabled?|disabled?|supports?|uses?|toggle)[-_]|.*[-_](?:layout|page|template|view|enabled|disabled|open|closed|on|off|true|false)$", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BAD_ROLE = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"])
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: an attribute with its value up to an opening quote
ATTRIBUTE = re.compile(r"[\s/]*(?:(=?[^\s=/>]+)\s*(=)?\s*)?")
BARE = re.compile(r"[^\s>]*")
CLOSE = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
CONTAINERS = frozenset(["body", "html", "main", "article", "section", "div", "td", "blockquote", "center", "header", "form", "aside"])
DEPTH = 500
#: why an element may be left out: never shown; by its tag or role; by a name; as reader comments
KEPT, GONE, FURNITURE, NAMED, COMMENTS = range(5)


class Node:
    __slots__ = ("tag", "parent", "kids", "doubt", "bad", "linked_to", "depth", "points", "below", "size", "linked", "own", "own_linked", "commas")

    def __init__(self, tag: str, parent, doubt: int = KEPT):
        self.tag, self.parent, self.kids, self.doubt = tag, parent, [], doubt
        self.bad = doubt == GONE
        self.linked_to = tag == "a" or (parent is not None and parent.linked_to)
        self.depth = parent.depth + 1 if parent is not None else 0
        self.clear()

    def clear(self):
        self.points = self.below = 0.0
        self.size = self.linked = self.own = self.own_linked = self.commas = 0


def _attributes(page: str, at: int, spent: set) -> tuple[list[tuple[str, str]], int]:
    """Names and values from ``at`` on, and the place behind the tag; ``spent`` holds quotes that occur no more."""
    out = []
    end = len(page)
    while at < end:
        m = ATTRIBUTE.match(page, at)
        at = m.end()
        name = (m[1] or "").lower()
        if not name:
            if at < end and page[at] == ">":
                return out, at + 1
            at += m.end() == m.start()  # a lone character
            continue
        value = ""
        if m[2] and at < end and page[at] in "\"'":
            quote = page[at]
            stop = -1 if quote in spent else page.find(quote, at + 1)
            if stop < 0:
                spent.add(quote)
                stop = page.find(">", at)
                value, at = (page[at + 1 : stop], stop) if stop >= 0 else (page[at + 1 :], end)
            else:
                value, at = page[at + 1 : stop], stop + 1
        elif m[2]:
            bare = BARE.match(page, at)
            value, at = bare[0], bare.end()
        out.append((name, value))
    return out, end


def _doubt(tag: str, attributes: list[tuple[str, str]], in_article: bool) -> int:
    found = FURNITURE if tag in OUT or (tag == "header" and not in_article) else KEPT
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDDEN.search(value)):
            return GONE
        if name == "role" and value.lower() in BAD_ROLE:
            found = found or FURNITURE
        elif name in ("class", "id") and tag not in ("body", "html", "main"):
            names = [CAMEL.sub("-", x) for x in entities.unescape(value).split() if not FLAG.match(x)]
            if any(COMMENT_NAME.search(x) for x in names):
                found = COMMENTS
            elif any(BAD_NAME.search(x) for x in names):
                found = found or NAMED
    return found


def parse(page: str) -> Node:
    root = Node("html", None)
    now, at, end = root, 0, len(page)
    spent: set = set()  # closing tags and quotes that are known to occur no more
    opened: dict[str, int] = {}  # elements on the path by tag

    def leave(to: Node) -> Node:
        nonlocal now
        while now is not to:
            opened[now.tag] -= 1
            now = now.parent
        return now

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            now.kids.append(page[at:])
            break
        if lt > at:
            now.kids.append(page[at:lt])
        at = lt + 1
        sign = page[at : at + 1]
        if sign in ("!", "?") and sign:
            mark = next((x for x in (("!--", "-->"), ("![CDATA[", "]]>")) if page.startswith(x[0], at)), None)
            stop = -1
            if mark and mark[1] not in spent and (stop := page.find(mark[1], at + len(mark[0]) - 2 * (mark[0] == "!--"))) < 0:
                spent.add(mark[1])
            if mark and stop < 0 and mark[0] == "!--":
                break  # a comment that is not closed hides the rest
            if stop >= 0:
                at = stop + 3
            else:
                stop = page.find(">", at)
                at = stop + 1 if stop >= 0 else end
            continue
        closing = sign == "/"
        m = NAME.match(page, at + closing)
        if m is None:
            if closing:
                stop = page.find(">", at)
                at = stop + 1 if stop >= 0 else end
            else:
                now.kids.append("<")
            continue
        tag = m[0].lower()
        attributes, at = _attributes(page, m.end(), spent)
        if closing:
            if not opened.get(tag):
                continue
            up = now
            while up.tag != tag and (tag in BLOCK or up.tag not in BLOCK):
                up = up.parent
            if up.tag == tag:
                leave(up.parent)
            continue  # an inline element ends with the block it was opened around
        if tag in RAW:
            stop = None if tag in spent else CLOSE[tag].search(page, at)
            if stop:
                at = stop.end()
            else:
                spent.add(tag)
                at = end if tag in ("script", "style", "textarea") else at
            continue
        if tag in ("html", "body"):
            if tag == "body" and not opened.get("body"):
                leave(root)
                now = Node("body", root)
                root.kids.append(now)
                opened["body"] = 1
            continue
        if tag in ENDS_P and opened.get("p"):
            up = now
            while up.tag not in BLOCK and up.parent is not None:  # open inline elements end with the paragraph
                up = up.parent
            if up.tag == "p":
                leave(up.parent)
        if tag in SIBLINGS:
            kinds, within = SIBLINGS[tag]
            up, last = now, None
            while up is not None and up.tag not in within:
                if up.tag in kinds:
                    last = up
                up = up.parent
            if last is not None:
                leave(last.parent)
        node = Node(tag, now, _doubt(tag, attributes, bool(opened.get("article"))))
        now.kids.append(node)
        if tag not in VOID and node.depth < DEPTH:
            now = node
            opened[tag] = opened.get(tag, 0) + 1
    return root


def _clean(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def _below(root: Node) -> list[Node]:
    """All nodes that are not left out, each before its children."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(k for k in n.kids if not isinstance(k, str) and not k.bad)
    return out


def _sums(nodes: list[Node]) -> None:
    """Sizes of text and of linked text, of each node's own paragraph and of all below it."""
    for n in nodes:
        n.clear()
    for n in reversed(nodes):
        for k in n.kids:
            if isinstance(k, str):
                got = len(" ".join(k.split()))
                n.own += got
                n.own_linked += got * n.linked_to
                n.commas += k.count(",")
        n.size += n.own
        n.linked += n.own_linked
        up = n.parent
        if up is None:
            continue
        if n.tag not in BLOCK:  # part of the paragraph around it
            up.own += n.own
            up.own_linked += n.own_linked
            up.commas += n.commas
            up.size += n.size - n.own
            up.linked += n.linked - n.own_linked
        else:
            up.size += n.size
            up.linked += n.linked


def furnish(root: Node) -> list[Node]:
    """Leave out furniture; the nodes that stay."""
    nodes = _below(root)
    _sums(nodes)
    heading = set()
    for n in reversed(nodes):
        if n.tag in ("h1", "main") or id(n) in heading:
            heading.add(id(n.parent))
    doubted = {id(n) for n in nodes if n.doubt}
    whole = root.size - root.linked
    # text outside of all doubted boxes, and as much of it as an article or main element marks
    plain = marked = 0
    stack = [(root, False)]
    while stack:
        n, inside = stack.pop()
        inside = inside or n.tag in ("article", "main")
        own = 0 if n.linked_to else sum(len(" ".join(k.split())) for k in n.kids if isinstance(k, str))
        plain, marked = plain + own, marked + own * inside
        stack.extend((k, inside) for k in n.kids if not isinstance(k, str) and not k.bad and id(k) not in doubted)
    within = set()
    for n in nodes:
        if n.tag in ("article", "main") or (n.parent is not None and id(n.parent) in within):
            within.add(id(n))
        if not n.doubt:
            continue
        text = n.size - n.linked
        if n.doubt in (NAMED, COMMENTS) and id(n) in heading:
            continue
        if n.doubt == COMMENTS or n.tag == "aside":
            n.bad = whole - text > 0
        elif n.tag in ("nav", "footer", "head"):
            n.bad = True
        else:
            n.bad = 2 * text <= whole or plain >= text or (marked > 0 and id(n) not in within)
    nodes = _below(root)
    _sums(nodes)
    return nodes


def best(root: Node) -> list[Node]:
    """The best container and the boxes beside it that are kept, in page order."""
    nodes = furnish(root)
    for p in nodes:
        if p.tag not in BLOCK or p.own - p.own_linked <= 0:
            continue
        points = (1 + p.commas + min(p.own // 100, 3) + p.own / 200) * (1 - p.own_linked / p.own)
        # text right in a container counts for the container itself
        up = p if p.tag in CONTAINERS else p.parent
        p.below += points
        for _ in range(3):
            if up is None:
                break
            up.points += points
            points /= 2
            up = up.parent
    for n in reversed(nodes):
        n.points *= 1 - n.linked / max(n.size, 1)
        if n.parent is not None:
            n.parent.below += n.below
    top = max(nodes, key=lambda n: n.points)
    if not top.points:
        return []
    # an article of which it holds most points is the container, whatever its inner boxes
    up = top.parent
    while up is not None:
        if up.tag == "article" and 2 * top.below >= up.below:
            top = up
        up = up.parent
    while top.parent is not None and top.tag not in CONTAINERS:
        top = top.parent
    kept = [top]
    now = top
    while now.parent is not None:
        around = []
        for k in now.parent.kids:
            if k is now:
                around += kept
            elif not isinstance(k, str) and not k.bad and k.size and _beside(k, top, now):
                around.append(k)
        kept, now = around, now.parent
    return kept


def _beside(k: Node, top: Node, now: Node) -> bool:
    """Whether a sibling of the best container (or of a box around it) belongs to the text."""
    dense = k.linked / k.size
    if dense < 0.5 and k.below >= (0.2 * top.below if k.tag == top.tag == "article" else max(10.0, 0.2 * top.below)):
        return True
    return now is top and top.tag != "article" and dense < 0.25 and k.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") and (k.size > 80 or k.tag != "p")


def _inline(node: Node):
    """Pieces of the text right in a block, with inline elements."""
    stack = [iter(node.kids)]
    while stack:
        for k in stack[-1]:
            if isinstance(k, str):
                yield k
            elif k.tag == "br":
                yield " "
            elif not k.bad and k.tag not in BLOCK:
                stack.append(iter(k.kids))
                break
        else:
            stack.pop()


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def flush():
        text = _clean(parts)
        parts.clear()
        if text:
            out.append(text)

    stack = [(node, iter(node.kids))]
    while stack:
        n, kids = stack[-1]
        for k in kids:
            if isinstance(k, str):
                parts.append(k)
            elif k.bad:
                continue
            elif k.tag == "br":
                parts.append(" ")
            else:
                if k.tag in BLOCK:
                    flush()
                stack.append((k, iter(k.kids)))
                break
        else:
            stack.pop()
            if n.tag in BLOCK:
                flush()
    flush()
    return out


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by line ends."""
    if not page:
        return ""
    return "\n".join(b for n in best(parse(page)) for b in blocks(n))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row: one pass, no shuffle."""
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    kind = pages.schema["page_id"].dataType.simpleString()

    @W.lean
    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
