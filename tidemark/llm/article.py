"""Main text of web pages by composite text density.

A page becomes a tree.  Every node gets its characters per tag, adjusted for link
text (composite text density), and the sum of its children's densities.  The node
with the greatest sum is the content; the least density on its path to the body is
the threshold, and further nodes at or above it give their own best subtree.  If
the content stands in an ``article`` element, that whole element is taken.

Before that, elements that by name, role or class are menus, headers, footers,
side bars, notices, adverts, forms or reader comments are set aside with scripts
and styles.

Text: character references decoded, white space within a block made one space and
trimmed, blocks joined by one line end in page order.

Rows: null or empty html, and a page without text, give an empty text; unclosed or
stray tags, comments and quotes never fail; an empty table gives no rows.  An added
column replaces one of its name.
"""

from __future__ import annotations

import bisect
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from .common import text_of, with_columns_from

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot".split())
# What a new element of this name ends, and what that search does not cross.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}
ASIDE = frozenset("nav header footer aside form script style noscript textarea title xmp iframe noembed noframes "
                  "template button select option input label dialog svg canvas object menu head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment "
    "comments commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promoted promotion related replies responses share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
# Full compounds: a slug that merely begins or ends with a name ("related-work") is none.
COMPOUNDS = frozenset(
    "ad-banner ad-block ad-box ad-container ad-slot ad-unit ad-wrapper ads-container banner-ad bottom-nav "
    "breadcrumb-nav comment-form comment-list comment-section comments-area comments-list comments-section "
    "cookie-banner cookie-bar cookie-consent cookie-notice footer-links footer-menu footer-nav footer-widgets "
    "header-menu header-nav left-sidebar main-menu main-nav main-navigation menu-container mobile-menu mobile-nav "
    "modal-dialog nav-bar nav-links nav-menu newsletter-form newsletter-signup page-footer page-header primary-menu "
    "primary-nav related-articles related-content related-links related-posts related-stories right-sidebar "
    "share-bar share-buttons share-links side-bar side-nav sidebar-left sidebar-right site-banner site-footer "
    "site-header site-menu site-nav site-navigation social-icons social-links social-media social-share "
    "sponsored-content sub-nav top-bar top-menu top-nav top-navigation "
    "user-comments widget-area".split())
# What may stand beside a name in a slug without making it a text of its own
# ("comment-thread", "ad_1", "adBox", but not "related-work" or "ad-free").
HOLDERS = frozenset(
    "area banner bar block bottom box btn button card center column container content desktop div field floating frame "
    "group holder inner item items label layer left link links list main mobile module outer overlay page panel "
    "placeholder placement popover popup position post posts primary reader right row section secondary site slot small "
    "sticky sub tab tabs target text thread threads tile title top unit user users view wrap wrapper zone".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
# One attribute: its name, then its whole value.  A quote that is never closed runs to the end.
_ATTR = re.compile(r"""([^\s"'=/>]++)(?:\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s"'>][^\s>]*+))?|"[^"]*+"?|'[^']*+'?""")
_PART = re.compile("__|--")     # "nav__item" is a part of "nav"
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")     # of a slug, also of camel case
_SPACE = re.compile(r"\s+")


def _names_aside(slug: str) -> bool:
    """Whether a class or id names boilerplate: a name, a listed compound, or a name with
    nothing but holders and numbers beside it."""
    whole = _PART.split(slug, maxsplit=1)[0]
    low = whole.lower().replace("_", "-")
    if low in NAMES or low in COMPOUNDS:
        return True
    words = [w.lower() for w in _WORDS.findall(whole)]
    named = [w in NAMES for w in words]
    return any(named) and all(n or w in HOLDERS or w.isdigit() for n, w in zip(named, words))


def set_aside(name: str, attrs: str, in_article: bool = False) -> bool:
    """Whether an element is no main text by itself; an article's own header is."""
    if name in ASIDE and not (name == "header" and in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs.lower():
        return False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in HEADINGS and name not in ("html", "body", "article", "main"):
            if any(map(_names_aside, value.split())):
                return True
    return False


class Tree:
    """Nodes in page order: name, parent, whether set aside; and the page as a run
    of (node, text) and (node, None) for a block's edge."""

    def __init__(self, page: str):
        self.name, self.parent, self.aside = ["#root"], [0], [False]
        self.run: list[tuple[int, str | None]] = []
        self.open = [0]
        self.depths: dict[str, list[int]] = {}     # of the open elements, by name
        self.walls: list[int] = []                 # of the open blocks but paragraphs
        at = 0
        while True:
            m = _TAG.search(page, at)
            if m is None:
                self._text(page[at:])
                break
            if m.start() > at:
                self._text(page[at:m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            if m["end"] or m["end2"]:
                self._close(name)
                continue
            attrs = m["attrs"] or m["attrs2"] or ""
            self._open(name, attrs)
            if name in RAW and not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
        self.run.append((0, None))

    def _text(self, raw: str) -> None:
        if raw:
            self.run.append((self.open[-1], html.unescape(raw)))

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            name = self.name[node]
            self.depths[name].pop()
            if name in BLOCK:
                self.run.append((self.open[-1], None))
                if name != "p":
                    self.walls.pop()

    def _push(self, node: int) -> None:
        name, depth = self.name[node], len(self.open)
        self.open.append(node)
        self.depths.setdefault(name, []).append(depth)
        if name in BLOCK and name != "p":
            self.walls.append(depth)

    def _last(self, name: str) -> int:
        """Depth of the innermost open element of this name, 0 if none is."""
        at = self.depths.get(name)
        return at[-1] if at else 0

    def _open(self, name: str, attrs: str) -> None:
        if name in ("html", "body") and self._last(name):
            return
        if name == "body":
            self._pop_to(1 + ("html" in (self.name[n] for n in self.open[1:2])))
        wants, wall = ENDS.get(name, (None, None))
        if name in CLOSES_P:
            self._end({"p"}, self.walls[-1] if self.walls else 0)
        if wants:
            self._end(wants, max(map(self._last, wall)))
        node, up = len(self.name), self.open[-1]
        self.name.append(name)
        self.parent.append(up)
        self.aside.append(self.aside[up] or set_aside(name, attrs, bool(self._last("article"))))
        if name in BLOCK:
            self.run.append((up, None))
        elif name == "br":
            self.run.append((up, " "))
        if name not in VOID and not attrs.endswith("/"):
            self._push(node)

    def _end(self, names, wall: int) -> None:
        """End the open elements of these names that lie deeper than the wall."""
        found = []
        for name in names:
            at = self.depths.get(name, [])
            found += at[bisect.bisect_right(at, wall):][:1]
        if found:
            self._pop_to(min(found))

    def _close(self, name: str) -> None:
        if name in ("html", "body"):
            return
        depth = self._last(name)
        if not depth or name not in BLOCK and depth < max(self._last("p"), *self.walls[-1:], 0):
            return                         # an inline end tag does not end a block
        self._pop_to(depth)


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite text density of each node, and the sum over its children."""
    n = len(tree.name)
    chars, links, tags, anchors = [0] * n, [0] * n, [0] * n, [0] * n
    inside = [False] * n
    for i in range(1, n):
        inside[i] = inside[tree.parent[i]] or tree.name[i] == "a"
    for node, text in tree.run:
        if text and not tree.aside[node]:
            size = len(text) - sum(map(len, _SPACE.findall(text)))
            chars[node] += size
            if inside[node]:
                links[node] += size
    for i in range(n - 1, 0, -1):
        if tree.aside[i]:
            continue
        up = tree.parent[i]
        chars[up] += chars[i]
        links[up] += links[i]
        tags[up] += tags[i] + 1
        anchors[up] += anchors[i] + (tree.name[i] == "a")
    whole, linked = max(chars[0], 1), links[0]
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c, t = chars[i], max(tags[i], 1)
        if not c or tree.aside[i]:
            continue
        base = math.log(c / max(c - links[i], 1) * links[i] + linked / whole * c + math.e)
        value = c / max(links[i], 1) * t / max(anchors[i], 1)
        density[i] = c / t * (math.log(value) / math.log(base) if value > 1 and base > 1 else 0.0
                              if value <= 1 else math.log(value))
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def main_nodes(tree: Tree) -> set[int]:
    """Roots of the subtrees that hold the main text."""
    density, total = densities(tree)
    n = len(tree.name)
    score = [s if s > 0 else d for s, d in zip(total, density)]   # a text-only body is its own best
    body = next((i for i in range(n) if tree.name[i] == "body"), 0)
    below = [False] * n
    below[body] = True
    for i in range(body + 1, n):
        below[i] = below[tree.parent[i]]
    if not any(density[i] > 0 for i in range(n) if below[i]):
        body, below = 0, [True] * n
    live = [i for i in range(n) if below[i] and not tree.aside[i] and density[i] > 0]
    if not live:
        return set()
    # best node of each subtree, children before parents
    best = list(range(n))
    for i in range(n - 1, -1, -1):
        up = tree.parent[i]
        if i != up and score[best[i]] > score[best[up]]:
            best[up] = best[i]
    top = best[body]
    least, i = density[top], top
    while i != body and i:
        i = tree.parent[i]
        least = min(least, density[i])
    above, i = {0, top}, top
    while i:
        i = tree.parent[i]
        above.add(i)
    chosen, covered = {top}, [False] * n
    for i in live:                          # parents come before children
        covered[i] = i in chosen or (i != body and covered[tree.parent[i]])
        if not covered[i] and density[i] >= least and best[i] not in chosen and i not in above:
            chosen.add(best[i])
            covered[i] = best[i] == i
    article = [0] * n                       # the outermost article a node stands in
    for i in range(1, n):
        article[i] = article[tree.parent[i]] or i * (tree.name[i] == "article")
    return {article[node] or node for node in chosen}


def main_text(page: str) -> str:
    if not page:
        return ""
    tree = Tree(page)
    chosen = main_nodes(tree)
    n = len(tree.name)
    kept = [False] * n
    for i in range(n):
        kept[i] = i in chosen or (i > 0 and kept[tree.parent[i]])
    blocks, words = [], []
    for node, text in tree.run:
        if text is None:
            if words:
                block = " ".join("".join(words).split())
                if block:
                    blocks.append(block)
                words = []
        elif kept[node] and not tree.aside[node]:
            words.append(text)
    if words:
        blocks.append(" ".join("".join(words).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", keep_html: bool = False) -> DataFrame:
    """``pages`` with the main text of each page."""
    def make():
        return lambda rows: (pa.array([main_text(r) for r in rows], pa.string()),)

    return with_columns_from(pages.withColumn(html_col, text_of(html_col)), html_col, make,
                             [StructField(text_col, StringType())], drop=() if keep_html else (html_col,))
