"""Main text of web pages by tree scoring.

A page is read into a tree of elements (unclosed and stray tags are mended the
way browsers do for blocks). Text in paragraph-like blocks earns points, 1 and one
for each comma and each 100 characters (3 at most); a block passes its points to its
parent, half of them to its grandparent, and less to higher ancestors. A
container's points are scaled by its
share of text outside links. The container with most points is the article; its
siblings join it when they have enough points themselves or are
paragraphs of plain text. Navigation, headers and footers of the page, asides, forms,
scripts, styles and elements named as adverts, notices, sidebars, menus or
comments are taken out first; but not an element with a name of its own that names the
article (``class="post no-comments"``, unlike ``post-comments``), nor one that holds the page's <article> or
<main>, nor, where nothing outside it is marked as the article, one that holds most of the paragraph
points, nor a section of prose whose name tells what it is about (``related-work``, and in the
article ``id="discussion"`` with a heading). These go by their points. Lists of links outside the article are left out; those in an
<article> or <main>, or between paragraphs, belong to it.

The text: character references decoded, white space inside a block squeezed to one
space and trimmed, blocks in page order joined by a line feed. Nothing is cut.
A null or empty page, or one without text, gives an empty text; page rows pass one by
one; extra columns pass by unread.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_slices, texts_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
# Elements that are no article text, wherever they stand.
DROP = frozenset("head script style noscript template iframe object embed svg canvas audio video map nav aside "
                 "annotation annotation-xml form button select option input textarea label fieldset footer dialog menu".split())
BLOCK = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr "
                  "td th caption blockquote pre figure figcaption address hr header footer nav aside form fieldset "
                  "details summary hgroup center".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks whose text earns points.
SCORED = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article main".split())
# Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption li dt dd".split())
# Start tag: open elements that it ends, and elements beyond which it does not look.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
        "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
# Words of class, id or role names that name other parts than the article (fixed values).
UNLIKELY = frozenset("""
ad ads adsbygoogle adbox adslot advert advertisement adverts banner breadcrumb breadcrumbs captcha comment commentlist
comments community complementary consent contentinfo cookie cookies dialog discussion disqus foot footer gdpr login
masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination
paywall popup promo recommended related remark replies respond rss search share sharing sidebar sidenav signup social
sponsor sponsored subscribe subscription toolbar tooltip widget""".split())
# Those of them that also name what an article's section is about.
ABOUT = frozenset("community dialog discussion foot login menu navigation recommended related remark search subscription".split())
# Beside a word of ABOUT: what other pages of the site are called.
OTHER_PAGES = frozenset("""
article articles box bar button content form items links news pages post posts products reading stories story topics
videos""".split())
# Words of readers' comments.
TALK = frozenset("comment commentlist comments disqus replies reply respond".split())
# Words that name the article.
LIKELY = frozenset("article body content entry hentry main page post story text".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|$)", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
                    r"|(?=[\s/>]|$))", re.I | re.S)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "hidden", "likely", "kids", "up", "points", "size", "linked", "links", "prose", "marks",
                 "heads", "talk", "chars", "anchors", "whole")

    def __init__(self, tag, up=None, names=frozenset(), hidden=False, likely=False, whole=False):
        self.tag, self.up, self.names, self.hidden, self.likely, self.whole = tag, up, names, hidden, likely, whole
        self.heads = self.talk = self.chars = self.anchors = 0  # headings, parts of comments or forms, text, linked text
        self.prose = self.marks = 0  # paragraph points, and elements marked as the article
        self.kids: list = []  # Nodes and texts in page order
        self.points = 0.0
        self.size = self.linked = self.links = 0  # characters, those in links, links


class Open:
    """The open elements, with the depths at which each tag stands, so that no tag walks through others."""

    def __init__(self, root: Node):
        self.path, self.depths, self.blocks = [root], {}, [0]

    def push(self, node: Node) -> None:
        depth = len(self.path)
        self.path.append(node)
        self.depths.setdefault(node.tag, []).append(depth)
        if node.tag in BLOCK:
            self.blocks.append(depth)

    def end(self, depth: int) -> None:
        """End the element at a depth and all inside it."""
        while len(self.path) > depth:
            tag = self.path.pop().tag
            self.depths[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def last(self, tag: str) -> int:
        """The depth of the innermost open element of a tag; 0 if there is none."""
        at = self.depths.get(tag)
        return at[-1] if at else 0

    def close(self, tag: str) -> None:
        """An end tag. One without its start tag is ignored; an inline one reaches no further than its block."""
        depth = self.last(tag)
        if depth and (tag in BLOCK or depth > self.blocks[-1]):
            self.end(depth)

    def make_room(self, tag: str) -> None:
        """End elements that this start tag implies the end of."""
        if tag in ENDS_P and self.path[self.blocks[-1]].tag == "p":
            self.end(self.blocks[-1])
        if tag in HEADING and self.path[-1].tag in HEADING:
            self.end(len(self.path) - 1)
        if tag in ENDS:
            ended, stop = ENDS[tag]
            bound = max(map(self.last, stop))
            if tag == "tr":  # the outermost cell or row of this table
                inside = [at[i] for at in map(self.depths.get, ended) if at for i in [bisect_right(at, bound)] if i < len(at)]
                if inside:
                    self.end(min(inside))
            elif (depth := max(map(self.last, ended))) > bound:
                self.end(depth)


def parse(page: str) -> Node:
    """The tree of a page. A character reference is decoded in its text."""
    root = Node("#root")
    tree, pos, end = Open(root), 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if not m:
            tree.path[-1].kids.append(html.unescape(page[pos:]))
            break
        if m.start() > pos:
            tree.path[-1].kids.append(html.unescape(page[pos:m.start()]))
        pos = m.end() if m.end() > m.start() else m.start() + 1
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            tree.close(tag)
            continue
        tree.make_room(tag)
        at = tree.path[-1]
        node = Node(tag, at, *(_attributes(m[3]) if m[3] else ()))
        at.kids.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
            if tag in ("title", "textarea"):
                node.kids.append(html.unescape(page[pos:stop.start() if stop else end]))
            pos = stop.end() if stop else end
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            tree.push(node)
    return root


def _words(names: str) -> frozenset:
    return frozenset(w.lower() for w in _WORD.findall(names))


def _attributes(raw: str) -> tuple[frozenset, bool, bool, bool]:
    """The words of class, id and role, whether the element is not shown, whether one of its names
    names the article and no other part, and whether one is made of words for other parts only."""
    names, hidden = [], False
    for m in _NAMES.finditer(raw):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if key in ("class", "id", "role"):
            names.append(value)
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key == "hidden" or value.lower() == "true":
            hidden = True
    words = _words(" ".join(names))
    each = [_words(name) for name in " ".join(names).split()] if words & (LIKELY | UNLIKELY) else []
    likely = any(w & LIKELY and not w & UNLIKELY for w in each)
    return words, hidden, likely, any(w and w <= UNLIKELY for w in each)


def _marked(n: Node) -> bool:
    return n.tag in ("article", "main") and not n.names & UNLIKELY or n.likely


def _measure(root: Node) -> None:
    """Paragraph points, marks of the article, headings, traces of comments and forms, and text and linked text, of
    all elements that are shown."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [k for k in n.kids if isinstance(k, Node) and not k.hidden and k.tag not in DROP]
    for n in reversed(order):
        if n.tag in ("p", "pre", "blockquote"):
            text = _own_text(n)
            if text:
                n.prose += 1 + text.count(",") + text.count("，") + min(len(text) // 100, 3)
        n.marks += _marked(n)
        n.heads += n.tag in HEADING
        n.talk += bool(n.names & TALK) or any(isinstance(k, Node) and k.tag in ("form", "textarea") for k in n.kids)
        n.chars += sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        if n.up is not None:
            n.up.prose += n.prose
            n.up.marks += n.marks
            n.up.heads += n.heads
            n.up.talk += n.talk
            n.up.chars += n.chars
            n.up.anchors += n.chars if n.tag == "a" else n.anchors


def _holds_article(n: Node, in_article: bool, page: Node, above: int) -> bool:
    """Whether an element with a name of another part is rather the article or around it; ``above``: marked
    elements that it stands in."""
    if n.likely:
        return True
    if in_article and n.names & {"comment", "comments"}:
        return False
    alone = page.marks == above + n.marks  # nothing outside is marked as the article
    if alone and not in_article and n.marks and n.prose:
        return True
    return alone and 2 * n.prose > page.prose


def _own_section(n: Node, in_article: bool) -> bool:
    """Whether an element is a section of prose whose name tells what it is about (``related-work``): its
    words for other parts are among ABOUT, it holds no comments, forms or lists of links, and, where a whole name is such a
    word (``id="discussion"``), it stands in the article and has a heading."""
    named = n.names & UNLIKELY
    if not named <= ABOUT or n.names & OTHER_PAGES or n.talk or n.tag not in ("section", "div"):
        return False
    if n.prose < 2 or 4 * n.anchors > n.chars:
        return False
    return not n.whole or in_article and n.heads > 0


def _other_part(n: Node, in_article: bool, page: Node, above: int) -> bool:
    """Whether an element is by its tag or names no part of the article."""
    if n.hidden or n.tag in DROP:
        return True
    if n.tag in ("html", "body", "article", "main") or n.tag in HEADING:
        return n.tag == "article" and "comment" in n.names
    if n.names & UNLIKELY and not _own_section(n, in_article) and not _holds_article(n, in_article, page, above):
        return True
    page_header = n.tag == "header" or "header" in n.names
    return page_header and not in_article and not n.names & {"article", "entry", "post", "story"}


def _prune(root: Node) -> None:
    """Take out what is no article, and count text and linked text."""
    _measure(root)
    todo = [(root, False, 0)]
    order = []
    while todo:
        n, in_article, above = todo.pop()
        order.append(n)
        n.kids = [k for k in n.kids if isinstance(k, str) or not _other_part(k, in_article, root, above)]
        todo += [(k, in_article or k.tag in ("article", "main"), above + _marked(k)) for k in n.kids if isinstance(k, Node)]
    for n in reversed(order):
        for k in n.kids:
            if isinstance(k, Node):
                n.size += k.size
                n.linked += k.size if k.tag == "a" else k.linked
                n.links += k.links + (k.tag == "a")
            else:
                n.size += len(k.strip())


def _link_list(n: Node) -> bool:
    """A block of links, as menus without a name are."""
    return n.tag in ("ul", "ol", "dl", "div", "section", "table") and n.links >= 3 and n.linked > 0.8 * n.size


def _own_text(n: Node) -> str:
    """Text of a block without that of blocks inside it."""
    parts, todo = [], list(reversed(n.kids))
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            parts.append(k)
        elif k.tag == "br":
            parts.append(" ")
        elif k.tag not in BLOCK:
            todo += reversed(k.kids)
    return _SPACE.sub(" ", "".join(parts)).strip()


def _weight(n: Node) -> float:
    w = {"article": 25.0, "main": 20.0, "div": 5.0, "section": 5.0, "pre": 3.0, "blockquote": 3.0, "td": 3.0,
         "ul": -3.0, "ol": -3.0, "li": -3.0, "dl": -3.0, "address": -3.0}.get(n.tag, 0.0)
    return w + 25.0 * bool(n.names & LIKELY)


def _score(root: Node) -> list[Node]:
    """Points of all containers; returns the containers that have some."""
    found: dict[int, Node] = {}
    todo = [root]
    while todo:
        n = todo.pop()
        todo += [k for k in reversed(n.kids) if isinstance(k, Node)]
        if n.tag not in SCORED:
            continue
        text = _own_text(n)
        if not text:
            continue
        points = 1 + text.count(",") + text.count("，") + min(len(text) // 100, 3)
        up, level = (n, 0) if n.tag in ("div", "section", "article", "main") else (n.up, 1)
        share = 1.0
        while up is not None and up.tag != "#root" and level < 5:
            if id(up) not in found:
                found[id(up)] = up
                up.points += _weight(up)
            up.points += points * share
            level += 1
            share = 1.0 if level == 1 else 0.5 if level == 2 else 1 / (3.0 * (level - 1))
            up = up.up
    for n in found.values():
        n.points *= 1 - n.linked / max(1.0, n.size)
    return list(found.values())


def _article(root: Node) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order."""
    scored = _score(root)
    if not scored:
        return [root]
    best = max(scored, key=lambda n: n.points)
    # A page's one <article> or <main> inside the best container, or around it, bounds the article.
    n = best
    while n.up is not None:
        if n.tag in ("article", "main"):
            return [n]
        n = n.up
    up = best.up
    if up is None or up.tag in ("#root", "html"):
        return [best]
    out, least = [], max(10.0, best.points * 0.2)
    for k in up.kids:
        if not isinstance(k, Node):
            continue
        plain = k.linked <= 0.25 * k.size
        if k is best or k.points >= least and plain or k.tag in HEADING and k.size and plain or \
                k.tag in ("p", "blockquote", "pre", "ul", "ol", "table", "figure") and k.size and plain and \
                (k.size > 80 or re.search(r"[.!?。]$", _own_text(k))):
            out.append(k)
    return out


def _paragraphs(top: Node) -> int:
    n, todo = 0, [top]
    while todo:
        k = todo.pop()
        n += k.tag in ("p", "pre", "blockquote") and k.size > 0
        todo += [x for x in k.kids if isinstance(x, Node)]
    return n


def _blocks(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    parts: list[str] = []
    seen = 0  # paragraphs so far
    every = sum(_paragraphs(top) for top in nodes)

    def flush():
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append(text)
        parts.clear()

    for top in nodes:
        flush()
        todo: list = [top]
        while todo:
            k = todo.pop()
            if k is None:
                flush()
            elif isinstance(k, str):
                parts.append(k)
            elif k.tag == "br":
                parts.append(" ")
            elif k.tag in BLOCK or k.tag == "#root":
                flush()
                if k is not top and top.tag not in ("article", "main") and not 0 < seen < every and _link_list(k):
                    continue
                seen += k.tag in ("p", "pre", "blockquote") and k.size > 0
                todo += [None, *reversed(k.kids)]
            else:
                todo += reversed(k.kids)
        flush()
    return out


def main_text(page: str) -> str:
    """The article's text of one page."""
    if not page or not page.strip():
        return ""
    root = parse(page)
    _prune(root)
    return "\n".join(_blocks(_article(root)))


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""

    def run(batches):
        for part, data, offs in text_slices(batches, html_column):
            texts = [main_text(t) for t in texts_of(data, offs)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    cols = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.col(html_column).cast("string").alias(html_column))
    return cols.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))
