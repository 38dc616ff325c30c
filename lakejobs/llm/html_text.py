"""Main text of web pages by composite text density.

For each node of the page's tree: characters per tag, adjusted for links. The
subtree whose children's densities sum to the most holds the article; the least
density on the path from there up to the body is the threshold by which parts
of the page are followed.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table ul".split()
)
#: Tags that end an open sibling, up to the container that holds both.
ENDS_SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

#: Parts that are no article text, by tag, role, and word of the class or id.
NOISE_TAGS = frozenset(
    "head script style noscript template iframe svg math canvas object embed audio video nav aside "
    "footer form button input select textarea option datalist dialog menu title xmp noembed "
    "noframes".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead topbar "
    "header cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus replies reply respond share sharing social "
    "related recommended widget widgets pagination pager skip toolbar commentlist".split()
)
#: Words of a name that say nothing of what a block holds: "comment-list", "related-posts".
FILLERS = frozenset(
    "area bar block body box button buttons container content group inner item items left link "
    "links list outer panel posts articles stories region right section slot text thread top "
    "unit wrap wrapper zone bottom form".split()
)
#: Names by which a paragraph itself is no article text.
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th".split())
#: What holds lines of a table or list.
PIECES = frozenset(
    "table tbody thead tfoot tr td th ul ol li dl dt dd p blockquote pre h1 h2 h3 h4 h5 h6".split()
)
SPOKEN = frozenset("p h1 h2 h3 h4 h5 h6".split())
UNSEEN_STYLE = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", re.I)

TAG = re.compile(
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
)
ATTRIBUTE = re.compile(
    r"([^\s\"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?"
)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Parts without text that a reader sees.
UNSEEN_TAGS = frozenset(
    "head script style noscript template iframe svg math canvas object embed audio video select "
    "option textarea datalist title xmp noembed noframes".split()
)
#: Before these, a noise word in a name says what a block has, not what it is.
HAVING = frozenset("has have with without no is js".split())
#: A header with one of these in its name is the article's.
OF_ARTICLE = frozenset("article post entry content main story page title body text".split())
#: Why a block is noise: it is not seen, by its tag or role, by its name.
UNSEEN, TAGGED, NAMED = 3, 2, 1


class Node:
    __slots__ = (
        "tag", "parent", "children", "kind", "noise", "own", "holds", "chars", "tags",
        "link_chars", "link_tags", "density", "total", "spoken",
    )

    def __init__(self, tag: str, parent: "Node | None", kind: int):
        self.tag, self.parent, self.kind = tag, parent, kind
        self.noise = self.holds = self.spoken = False
        self.own = 0
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def attributes_of(written: str) -> dict[str, str]:
    """Attributes by full name, in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(written):
        out.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    return out


def noise_of(tag: str, written: str, inside_article: bool) -> int:
    """Why a block is noise, or 0; whatever its length."""
    if tag in UNSEEN_TAGS:
        return UNSEEN
    kind = TAGGED if tag in NOISE_TAGS or (tag == "header" and not inside_article) else 0
    if tag in ("html", "body", "main") or not written:
        return kind
    values = attributes_of(written)
    if "hidden" in values or UNSEEN_STYLE.search(values.get("style", "")):
        return UNSEEN
    if (
        values.get("role", "").strip().lower() in NOISE_ROLES
        or values.get("aria-hidden", "").strip().lower() == "true"
    ):
        kind = TAGGED
    if not kind:
        names = f"{values.get('class', '')} {values.get('id', '')}".split()
        known = ADVERTS if tag in PARAGRAPHS else NOISE_WORDS
        if any(speaks_of(WORDS.findall(CAMEL.sub(" ", x).lower()), known) for x in names):
            kind = NAMED
    return kind


def speaks_of(words: list[str], known: frozenset[str]) -> bool:
    """Whether a name's words say that the block is one of the known kinds.

    The last word that is no filler says what a block is: "user-comments" and
    "comment-list" are comments, "share-price" is a price.
    """
    if not HAVING.isdisjoint(words[:-1]):
        return False
    at = len(words) - 1
    while at > 0 and words[at] in FILLERS and words[at] not in known:
        at -= 1
    if at < 0 or words[at] not in known:
        return False
    return words[at] != "header" or OF_ARTICLE.isdisjoint(words)


def judge(root: Node, headings: list[tuple[Node, bool]], articles: list[Node]) -> list[Node]:
    """Decide which parts are noise; the parts that are so by name only are returned.

    A block that holds the article is none, whatever its tag or name: the page's
    heading (the first inside an article, or the first at all), its main part, or
    its only article.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.children if isinstance(x, Node) and x.kind != UNSEEN]
    heading = next((h for h, inside in headings if inside), headings[0][0] if headings else None)
    only = articles[0] if len(articles) == 1 else None
    named = []
    for node in reversed(order):
        node.holds |= node is heading or node is only or node.tag == "main"
        for x in node.children:
            if isinstance(x, Node):
                if x.kind != UNSEEN:
                    node.own += x.own
                    node.holds |= x.holds
            elif node.tag != "a":
                node.own += blank(x)
    todo = [root]
    while todo:
        for x in todo.pop().children:
            if isinstance(x, Node):
                x.noise = x.kind == UNSEEN or (x.kind > 0 and not x.holds)
                if x.noise and x.kind == NAMED:
                    named.append(x)
                if not x.noise:
                    todo.append(x)
    return named


class Open:
    """The open nodes from the root down, with the places of each tag among them.

    To find the nearest open tag takes no walk, so deep pages take linear time.
    """

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {root.tag: [0]}

    @property
    def here(self) -> Node:
        return self.nodes[-1]

    def nearest(self, tags) -> int:
        """The place of the nearest open node with one of the tags; -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        """Close the node at the place and all below it; the root stays."""
        while len(self.nodes) > max(1, place):
            self.places[self.nodes.pop().tag].pop()

    def close(self, tag: str) -> None:
        """After an end tag: the nearest open node of that name ends, if any is open."""
        place = self.nearest((tag,))
        bound = self.nearest(("table", "td", "th")) if tag in INLINE or tag in ("p", "li") else -1
        if place > 0 and place >= bound:
            self.cut(place)

    def close_up_to(self, tags, stop) -> None:
        """The nearest open node of the tags ends, unless a container lies between."""
        place = self.nearest(tags)
        if place > 0 and place >= self.nearest(stop):
            self.cut(place)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its parts that are noise by name only.

    Open ends are closed as browsers do for these tags.
    """
    root = Node("html", None, 0)
    stack = Open(root)
    at, n = 0, len(page)
    headings: list[tuple[Node, bool]] = []
    articles: list[Node] = []
    closing: dict[str, bool] = {}

    def text(piece: str) -> None:
        if piece:
            stack.here.children.append(html.unescape(piece))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if m is None:
            if re.match(r"</?[A-Za-z]", page[lt : lt + 3]):
                # A tag with an open quote, or none that ends.
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                text("<")
                at = lt + 1
            continue
        at = m.end()
        tag, attributes = m.group(2).lower(), m.group(3)
        if m.group(1):
            stack.close(tag)
            continue
        if tag in ("html", "body"):
            if tag == "body":
                stack.cut(1)
            continue
        if tag in ENDS_P:
            stack.close_up_to(("p",), ("table", "td", "th", "button", "li", "div", "article"))
        if tag in ENDS_SIBLING:
            stack.close_up_to(*ENDS_SIBLING[tag])
        inside = stack.nearest(("article", "main")) >= 0
        node = Node(tag, stack.here, noise_of(tag, attributes, inside))
        stack.here.children.append(node)
        if tag == "h1":
            headings.append((node, inside))
        elif tag == "article" and not node.kind:
            articles.append(node)
        if tag in RAW:
            if closing.get(tag, True):
                stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                closing[tag] = stop is not None
            else:
                stop = None
            if tag == "textarea" or tag == "title":
                node.children.append(html.unescape(page[at : stop.start() if stop else n]))
            at = stop.end() if stop else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.push(node)
    return root, judge(root, headings, articles)


def above(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def blank(piece: str) -> int:
    return len(" ".join(piece.split()))


def measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes but noise, from the leaves up; nodes top down.

    Inline tags belong to the block around them: they are no nodes of their own
    and, but for links, no tags.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.children if isinstance(x, Node) and not x.noise]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for x in node.children:
            if isinstance(x, str):
                node.chars += blank(x)
            elif not x.noise:
                node.spoken |= x.spoken or x.tag in SPOKEN
                node.chars += x.chars
                node.tags += x.tags + (x.tag == "a" or x.tag not in INLINE)
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    chars, links = max(1, root.chars), root.link_chars
    for node in order:
        node.density = density(node, links / chars)
    for node in reversed(order):
        node.total = sum(
            x.total if x.tag in INLINE else x.density
            for x in node.children
            if isinstance(x, Node) and not x.noise
        )
    return order


def density(node: Node, page_links: float) -> float:
    """Characters per tag, less the more of them are links and the more tags are."""
    c, t = node.chars, max(1, node.tags)
    if c == 0:
        return 0.0
    lc, lt = max(1, node.link_chars), max(1, node.link_tags)
    rest = max(1, c - node.link_chars)
    base = math.log(c / rest * node.link_chars + page_links * c + math.e)
    inside = c / lc * (t / lt)
    if inside <= 1:
        return 0.0
    return c / t * (math.log(inside) / base)


def runs(node: Node, path: set[int]) -> list[list[Node | str]]:
    """The children but noise: text with the inline nodes in it together, others alone."""
    out: list[list[Node | str]] = []
    open_ = False
    for x in node.children:
        if isinstance(x, Node) and x.noise:
            continue
        inside = isinstance(x, str) or (x.tag in INLINE and id(x) not in path)
        if inside and open_:
            out[-1].append(x)
        else:
            out.append([x])
        open_ = inside
    return out


def is_text(run: list[Node | str]) -> bool:
    """Whether a run is text with links in it rather than a list of links."""
    if not any(isinstance(x, str) and x.strip() for x in run):
        return False
    nodes = [x for x in run if isinstance(x, Node)]
    own = sum(blank(x) for x in run if isinstance(x, str)) + sum(x.own for x in nodes)
    return own > sum(x.link_chars for x in nodes)


def section_of(best: Node) -> Node:
    """The part of the page that the densest node stands for.

    A table or list without paragraphs is a piece of an article, so the block
    around it is taken; within an article or main part it is that part.
    """
    while best.parent is not None and best.tag in PIECES and not best.spoken:
        best = best.parent
    return next((x for x in above(best) if x.tag in ("article", "main")), best)


def article_text(page: str | None) -> str:
    """The article of a page: blocks in page order, single blanks; empty if there is none."""
    if not page:
        return ""
    root, named = parse(page)
    order = measure(root)
    if root.chars == 0 and named:
        # Nothing but blocks that are noise by name: then the names are wrong.
        for node in named:
            node.noise = False
        order = measure(root)
    if root.chars == 0:
        return ""
    best = max((x for x in order if x.tag not in INLINE), key=lambda x: x.total)
    best = section_of(best) if best.total > 0.0 else root
    threshold = min(x.density for x in above(best))
    out: list[str] = []

    def take(node: Node | str) -> None:
        """All text below a node, but noise."""
        todo: list[Node | str] = [node]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif not x.noise:
                apart = x.tag not in INLINE
                if apart:
                    out.append(" ")
                    todo.append(" ")
                todo += reversed(x.children)

    path = set(map(id, above(best)))
    todo: list[Node | str] = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or node is best or id(node) not in path:
            take(node)
            continue
        # On the path: the path itself, its own text, and what is as dense as its thinnest part.
        todo.append(" ")
        for run in reversed(runs(node, path)):
            whole = is_text(run)
            todo += [
                x
                for x in reversed(run)
                if whole or (isinstance(x, Node) and (id(x) in path or x.density >= threshold > 0))
            ]
        todo.append(" ")
    return " ".join("".join(out).split())


@F.pandas_udf(T.StringType())
def main_text(page: pd.Series) -> pd.Series:
    """The article of each page; empty for a null or empty page."""
    return pd.Series([article_text(p) for p in page], dtype=object)


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text and n_chars (its code points).

    Null and empty pages give an empty text. Repeated rows give repeated
    results; other columns are not looked at.
    """
    return pages.select(
        F.col(id_col), F.col(url_col), main_text(F.col(html_col)).alias("text")
    ).withColumn("n_chars", F.char_length("text").cast("long"))
