"""Main text of web pages (1): composite text density.

A page becomes a tree. What is never article text by its element, role, visibility or class goes
first: scripts, styles, heads, menus, footers, sidebars, notices, adverts, forms, reader comments.
Every node left has a composite density: its characters per tag, raised where few of the characters
lie in links and lowered where many do, against the page's own share of link text. A node's score is
the sum of its children's densities, and the node of the highest score holds the main text. On the
path from the body to that node the smallest density is the threshold. An article (the outermost) or a main
element around the node is the range in which text is kept; elsewhere parts beside the path stay if they
are text rather than links, and reach the threshold, end as a sentence does, or hold paragraphs and a
tenth of the node's characters. In what is kept, lists of links below the threshold, runs of links and
teasers of other articles go, with the headings right before them. Of equal scores the first in page
order counts.

Text is the chosen parts' blocks in page order.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import ship

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?")
_WATCHED = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden|itemprop)\b", re.I)
#: A last attribute without quotes: a slash at its end belongs to it.
_UNQUOTED = re.compile(r"=\s*+[^\s\"'>]+/\Z")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript noembed noframes iframe xmp template svg".split())
#: Elements of other languages; only these and what is in them can close themselves.
_FOREIGN = frozenset({"svg", "math"})
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul option".split()
)
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "html", "legend"}
#: Start tags that end an open element of these names, unless one of the walls lies between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_DROPPED = frozenset(
    "script style noscript noembed noframes template svg iframe object embed applet canvas head title nav footer aside "
    "form button select input textarea option dialog menu audio video map".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promotions banner banners sidebar "
    "sidebars nav navbar navigation navi menu menus breadcrumb breadcrumbs footer foot masthead topbar comment comments disqus replies "
    "respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget widgets toolbar pagination pager copyright disclaimer".split()
)
#: Words that say where a named part stands or how it is laid out, not what it is about.
_LAYOUT = frozenset(
    "site page main global left right top bottom upper lower header body inner outer content primary secondary box bar block container "
    "wrapper wrap holder area section panel row col column list links link item items slot unit group zone post posts article articles "
    "stories entry form button buttons icon icons sticky fixed mobile desktop user reader readers recent latest popular more x".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HOLDERS = frozenset("body article main section div center td".split())
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*\Z")
_COPYRIGHT = re.compile(r"\s*(?:©|\(c\)|copyright\b)", re.I)
#: A list of links has this many at least.
LEAST_LINKS = 3
_KEPT = frozenset({"html", "body", "article", "main"})
_PROSE = _HEADINGS | {"p", "pre", "code"}
_ITEMS = frozenset("li dt dd tr td th".split())


class Node:
    __slots__ = ("tag", "parent", "children", "attrs", "chars", "tags", "link_chars", "link_tags", "density", "score")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.attrs, self.children = tag, parent, attrs, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0


def parse(page: str) -> Node:
    """A tree of elements and decoded text; unclosed and misnested tags are mended as browsers do."""
    root = Node("html", None)
    at, here = 0, root
    lower, open_svg = None, False
    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            here.children.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                here.children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            here = _close(here, tag)
        elif tag in ("html", "body"):
            if tag == "body" and not _inside(here, "body"):
                while here.tag == "head":
                    here = here.parent
                here = _child(here, tag, attrs)
        else:
            here = _open(here, tag, attrs)
            if tag in _FOREIGN and attrs.endswith("/") and not _UNQUOTED.search(attrs):  # it has no content
                here = here.parent
            elif tag in _RAW:
                lower = lower or page.lower()
                lower = lower if len(lower) == len(page) else page
                end = -1 if tag == "svg" and open_svg else lower.find(f"</{tag}", at)
                if end < 0 and tag == "svg":  # never closed: what follows is not inside
                    open_svg, here = True, here.parent
                    continue
                end = len(page) if end < 0 else end
                # What is inside is no markup, and none of these elements holds article text.
                at, here = end, here
    return root


def _child(here: Node, tag: str, attrs: str) -> Node:
    node = Node(tag, here, attrs)
    here.children.append(node)
    return node


def _inside(here: Node | None, tag: str) -> bool:
    while here:
        if here.tag == tag:
            return True
        here = here.parent
    return False


def _open(here: Node, tag: str, attrs: str) -> Node:
    if tag in _CLOSES_P:
        node = here
        while node and node.tag != "p" and node.tag not in ("td", "th", "table", "button", "body", "html", "article", "div", "li"):
            node = node.parent
        if node and node.tag == "p":
            here = node.parent
    if tag in _ENDS:
        ended, walls = _ENDS[tag]
        node = here
        while node and node.tag not in ended and node.tag not in walls and node.tag not in ("body", "html"):
            node = node.parent
        if node and node.tag in ended:
            here = node.parent
    if here.tag == "head" and tag in _BLOCK:
        here = here.parent
    node = _child(here, tag, attrs)
    return here if tag in _VOID or attrs.rstrip().endswith("/") and tag in ("path", "use") else node


def _close(here: Node, tag: str) -> Node:
    node = here
    while node and node.tag != tag:
        if tag not in _BLOCK and node.tag in _BLOCK:
            return here  # an inline end tag does not close blocks
        node = node.parent
    if not node or node.parent is None:
        return here
    return node.parent if tag not in ("body", "html") else here


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _boilerplate(node: Node) -> bool:
    """Whether a node is none of the article by what its markup says."""
    if node.tag in _DROPPED:
        return True
    if node.tag == "header":
        return not (_inside(node.parent, "article") or _inside(node.parent, "main"))
    if node.tag in _KEPT and node.tag != "article" or not _WATCHED.search(node.attrs):
        return False
    attrs = _attributes(node.attrs)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in _ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    if node.tag in _HEADINGS or node.tag not in _BLOCK and node.parent.tag in _PROSE:
        return False  # an id or a class there is about the text
    names = attrs.get("class", "").split() + ([] if node.tag == "p" else attrs.get("id", "").split())
    if node.tag == "article":  # readers' comments are often articles of their own
        return any(_says(name, {"comment", "comments", "reply"}) for name in names)
    return any(_says(name, _NAMES) for name in names)


def _says(name: str, known) -> bool:
    """Whether a class or id is a known name, alone or among known names and words of layout: `related`,
    `related-posts` and `site_footer` are, `related-work` and `has-sidebar` are not."""
    words = {w.lower() for w in _NAME.findall(name)}
    return bool(words & known) and all(w in known or w in _NAMES or w in _LAYOUT or w.isdigit() for w in words)


def _order(root: Node) -> list[Node]:
    """All nodes in page order, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def _measure(nodes: list[Node]) -> None:
    """Characters and tags, all and in links, of every node."""
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
    for node in reversed(nodes):
        own = sum(len(_SPACE.sub("", c)) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars = node.chars
            node.link_tags = node.tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags


def _prune(root: Node) -> None:
    """Take out boilerplate, but no named part that holds an article or nearly all of a page's text."""
    nodes = _order(root)
    _measure(nodes)
    holds = set()
    for node in reversed(nodes):
        if (node.tag in ("article", "main") or id(node) in holds) and node.parent is not None:
            holds.add(id(node.parent))
    total = root.chars
    for node in nodes:
        kept = []
        for child in node.children:
            if isinstance(child, Node) and _boilerplate(child):
                whole = id(child) in holds or (10 * child.chars > 9 * total and child.tags > 3)
                if child.tag in _DROPPED or not whole:
                    continue
            kept.append(child)
        node.children = kept


def _densities(nodes: list[Node], body: Node) -> None:
    """Composite text density of every node, and the sum of its children's as its score."""
    _measure(nodes)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        if not node.chars:
            node.density = 0.0
            continue
        tags = max(node.tags, 1)
        plain = max(node.chars - node.link_chars, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
        node.density = node.chars / tags * math.log(max(node.chars / links * tags / link_tags, 1.0) + 1e-9) / math.log(base + 1)
        node.density = max(node.density, 0.0)
    for node in nodes:
        node.score = sum(c.density for c in node.children if isinstance(c, Node))


def _chosen(body: Node) -> list[Node | str]:
    """The parts of the page that hold the main text, in page order."""
    nodes = _order(body)
    _densities(nodes, body)
    best = max(nodes, key=lambda n: n.score)
    if best.score <= 0:
        return [body]
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    articles = [n for n in path if n.tag == "article"] or [n for n in path if n.tag == "main"][:1]
    if articles:
        path = path[: path.index(articles[-1]) + 1]
    threshold = min(n.density for n in path)
    _take_out_links(path, threshold)
    return path[-1:] if articles else _beside(path, threshold)


def _beside(path: list[Node], threshold: float) -> list[Node | str]:
    """The first node of the path and the parts of the others that belong to its text."""
    best = path[0]

    def belongs(part) -> bool:
        if isinstance(part, str):
            text = part.strip()
            return bool(text) and (len(part) >= threshold or bool(_SENTENCE_END.search(text))) and not _COPYRIGHT.match(text)
        if not part.chars or 2 * part.link_chars > part.chars:
            return False
        if part.tag == "h1" or part.density >= threshold:
            return True
        text = "".join(_blocks([part]))
        if _COPYRIGHT.match(text):
            return False
        return bool(_SENTENCE_END.search(text)) or 10 * part.chars >= best.chars and any(n.tag == "p" for n in _order(part))

    chosen: list[Node | str] = [best]
    for node in path[1:]:
        kept, follows = [], False  # from the last part to the first; a heading goes with what follows it
        for part in reversed(node.children):
            if isinstance(part, Node) and _holds(part, best):
                kept += reversed(chosen)
                follows = True
            elif isinstance(part, Node) and part.tag in _HEADINGS and part.chars and (follows or part.tag == "h1"):
                kept.append(part)
            elif belongs(part):
                kept.append(part)
                follows = True
            elif isinstance(part, Node) and part.chars:
                follows = False
        chosen = kept[::-1]
    return chosen


def _teaser(article: Node) -> bool:
    """Whether an article only leads to another page: it is a link, its heading is one, or it ends with one."""
    if article.link_chars == article.chars:
        return True
    if any(n.tag in _HEADINGS and n.chars and n.link_chars == n.chars for n in _order(article)):
        return True
    last = next((c for c in reversed(article.children) if (c.strip() if isinstance(c, str) else c.chars)), "")
    return isinstance(last, Node) and last.link_chars == last.chars


def _take_out_links(path: list[Node], threshold: float) -> None:
    """Take lists of links, runs of links and teasers out of the last node of the path, not nodes of the path."""
    top, held = path[-1], {id(n) for n in path}
    teasers, stack = [], [top]
    while stack:  # the outermost ones
        for child in stack.pop().children:
            if isinstance(child, Node):
                if child.tag == "article" and id(child) not in held and child.chars and _teaser(child):
                    teasers.append(child)
                else:
                    stack.append(child)
    rest = top.chars - sum(n.chars for n in teasers)
    gone = {id(n) for n in teasers if n.chars < rest}
    for node in _order(top):
        run: list[Node] = []
        begin = 0  # of the run, signs between links included
        words = any(isinstance(c, str) and any(x.isalnum() for x in c) for c in node.children)  # links may be part of a sentence
        for i, child in enumerate([*node.children, None] if node.tag in _HOLDERS else []):
            if child is None:
                linked = False
            elif isinstance(child, str):
                linked = not any(c.isalnum() for c in child)
            else:
                linked = child.link_chars == child.chars and id(child) not in held and not (words and child.tag not in _BLOCK)
                run += [child] if child.chars and linked else []
                if child.tag in _BLOCK - _PROSE - _ITEMS and id(child) not in held:
                    if child.link_tags >= LEAST_LINKS and 2 * child.link_chars > child.chars and child.density < threshold:
                        gone.add(id(child))
            if not linked:
                if len(run) >= LEAST_LINKS:
                    gone |= {id(c) for c in run}
                    node.children[begin:i] = [c if isinstance(c, Node) else " " for c in node.children[begin:i]]
                run, begin = [], i + 1
    for node in _order(top):
        if any(id(c) in gone for c in node.children):
            kept: list[Node | str] = []
            for child in node.children:
                if id(child) not in gone:
                    kept.append(child)
                    continue
                while kept and isinstance(kept[-1], str) and kept[-1].isspace():
                    kept.pop()
                if kept and isinstance(kept[-1], Node) and kept[-1].tag in _HEADINGS - {"h1"} and id(kept[-1]) not in held:
                    kept.pop()
            node.children = kept


def _holds(node: Node, other: Node | None) -> bool:
    while other is not None:
        if other is node:
            return True
        other = other.parent
    return False


def _blocks(parts: list[Node | str]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list = [*reversed(parts)]
    while stack:
        part = stack.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            run.append(part)
        elif part.tag == "br":
            run.append(" ")
        else:
            if part.tag in _BLOCK:
                flush()
                stack.append(None)
            stack += reversed(part.children)
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article of a page; blocks are joined by an empty line. A page without text gives ""."""
    if not page or page.isspace():
        return ""
    root = parse(page)
    _prune(root)
    body = next((n for n in _order(root) if n.tag == "body"), root)
    return "\n\n".join(_blocks(_chosen(body)))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of `pages`; n_chars counts code points.

    A null or empty page, and one without article text, gives an empty text. Repeated rows give a row
    each; other columns are ignored.
    """
    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
