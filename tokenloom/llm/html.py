"""Operator 2, HTML extraction: composite text density.

A page is parsed into a tree of elements.  Every element has its characters
``C``, tags ``T``, link characters ``LC`` and link tags ``LT``, all of its
subtree, and the link-adjusted density

    C/T * log(C*T / (LC*LT)) / log(ln(C*LC/(C-LC) + C*lc + e))

(counts at least 1, ``lc`` the share of link characters of the whole body).
The density sum of an element adds the densities of its children.  The
element with the largest sum is the heart of the article.  Its ancestors are
then walked up to the body: the last one whose density is above the
threshold, the body's own density (the lowest on the path as long as
furniture is denser in links than the article), is the article, so blocks
beside the heart are not lost.

Furniture is told by element (nav, header, footer, aside, form, ...) or by a
whole name in class, id or role (ad, menu, sidebar-left, comments, ...).  A
name does not decide for an element with most of the body's text outside
links, unless an article or main element stands beside it, or it is a name of
ads, readers' comments or cookie notices.  A header right inside an article or
main element is part of it.  Furniture counts as link text in the densities,
is never chosen, and is left out of the text.  A comment section that nothing
names as one is judged like any other text.

Text: character references decoded, white space in a block turned to one
space, trimmed; blocks in page order, joined by one line break.  Left out are
elements hidden by ``hidden``, ``aria-hidden`` or ``display: none``, those of
``SILENT``, and buttons that stand outside text blocks; nothing else is
dropped.  Null or empty html, and pages without text: the empty string.
Extra columns named ``text`` or ``n_chars`` give way to the results.
Repeated rows and extra columns pass through; an empty table gives an empty
result.  Parsing is linear in the page, however deep it nests and whatever
it leaves unclosed.
"""

from __future__ import annotations

import html as entities
import math
import re
from typing import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm.tables import map_arrow, read

# fixed values: elements of HTML by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset("script style noscript template head title svg object iframe canvas audio video noembed noframes select textarea annotation annotation-xml".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br button "
                   "math mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts mstyle mpadded menclose merror mphantom semantics".split())
# a button is text only inside one of these
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre summary figcaption caption".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
# an opening tag closes the open element of these names, up to the given containers
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "thead": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
            "option": ({"option"}, {"select"})}
# names of furniture in class, id and role; those of OTHERS tell whose text it is, however long
OTHERS = r"ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|comments?|disqus|replies|reply|respond|cookies?|consent"
LABEL_WORDS = (
    r"promo(?:tion)?s?|banner|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|side|"
    r"rail|widgets?|footer|header|masthead|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|"
    r"related|recommend(?:ed|ations)?|pagination|pager|toolbar|skip|copyright|legal|disclaimer|tags?|" + OTHERS)
# words that may stand beside them in a name: "sidebar-left", "related-posts"
PLACE_WORDS = r"site|top|bottom|left|right|inner|outer|wrap|wrapper|container|area|box|block|slot|unit|list|items?|section|links?|buttons?|icons?|bar|posts|primary|secondary|form|thread"
_LABEL_NAME = re.compile(rf"(?=.*(?<![a-z])(?:{LABEL_WORDS})(?![a-z]))(?:{LABEL_WORDS}|{PLACE_WORDS}|\d+)\d*(?:[_-]+(?:{LABEL_WORDS}|{PLACE_WORDS}|\d+)\d*)*", re.I)
_OTHERS_NAME = re.compile(rf"(?<![a-z])(?:{OTHERS})(?![a-z])", re.I)

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I) for name in RAW}
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SPACE = re.compile(r"\s+")


class Scanner:
    """Texts and tags of a page, in one pass.

    ``("text", text)``, ``("open", name, attributes, self-closing)`` or
    ``("close", name)``.  A quote opens a value only where a value
    begins, and only if it is closed later; what the page has no more of (a
    ``>``, either quote) is looked for once.  If the page ends inside a tag, that
    tag's ``<`` is text, and from there on a tag ends at the next ``>``.
    """

    def __init__(self, page: str):
        self.page, self.end = page, len(page)
        self.next_close = -1                       # the next ">" from the last place asked about
        self.no_quote = {'"': self.end, "'": self.end}   # none from there on
        self.plain = False

    def closing(self, at: int) -> int:
        """Place of the next ``>``, or the page's end."""
        if self.next_close < at:
            found = self.page.find(">", at)
            self.next_close = self.end if found < 0 else found
        return self.next_close

    def value(self, at: int) -> tuple[str, int]:
        quote = self.page[at:at + 1]
        if quote in self.no_quote and quote and at + 1 < self.no_quote[quote] and not self.plain:
            found = self.page.find(quote, at + 1)
            if found >= 0:
                return self.page[at + 1:found], found + 1
            self.no_quote[quote] = at + 1
        m = _UNQUOTED.match(self.page, at)
        return m[0].strip("\"'") if self.plain else m[0], m.end()

    def tag(self, at: int) -> tuple[str, dict[str, str], bool, int] | None:
        """The tag whose name begins at ``at``; None if the page ends in it."""
        name = _TAG_NAME.match(self.page, at)
        given: dict[str, str] = {}
        at = name.end()
        while True:
            gap = _GAP.match(self.page, at)
            at = gap.end()
            if at >= self.end:
                return None
            if self.page[at] == ">":
                return name[0].lower(), given, gap[0].endswith("/"), at + 1
            key = _ATTRIBUTE_NAME.match(self.page, at)
            at, text = key.end(), ""
            equals = _EQUALS.match(self.page, at)
            if equals:
                text, at = self.value(equals.end())
            given.setdefault(key[0].lower(), text)

    def __iter__(self):
        page, at, kept = self.page, 0, 0             # kept: where the text not yet given begins
        while True:
            lt = page.find("<", at)
            if lt < 0:
                yield "text", page[kept:]
                return
            follows, close = page[lt + 1:lt + 2], page.startswith("</", lt)
            letter = page[lt + 2:lt + 3] if close else follows
            if page.startswith("<!--", lt):
                found = page.find("-->", lt + 2)
                after = self.end if found < 0 else found + 3
            elif follows in ("!", "?") or close and not (letter.isascii() and letter.isalpha()):
                after = self.closing(lt) + 1
            elif letter.isascii() and letter.isalpha():
                tag = self.tag(lt + 1 + close) if self.closing(lt) < self.end else None
                if tag is None:
                    self.plain, at = True, lt + 1
                    continue
                name, given, own, after = tag
                yield "text", page[kept:lt]
                yield ("close", name) if close else ("open", name, given, own)
                if name in RAW and not close:
                    raw = _RAW_END[name].search(page, after)
                    yield "text", page[after:raw.start()]
                    yield "close", name
                    after = raw.end()
                at = kept = min(after, self.end)
                continue
            else:
                at = lt + 1
                continue
            yield "text", page[kept:lt]
            at = kept = min(after, self.end)


def hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true" or bool(_NO_DISPLAY.search(given.get("style", "")))


class Node:
    __slots__ = ("name", "parent", "block", "items", "furniture", "labelled", "silent", "plain", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, name: str, parent: "Node | None", furniture: bool = False, silent: bool = False):
        self.name, self.parent, self.items = name, parent, []
        self.block = name if parent is None or name not in INLINE else parent.block   # the nearest block's name
        self.furniture, self.silent = furniture, silent
        self.labelled = False   # furniture by a name only; ``settle`` decides
        self.plain = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def parse(page: str) -> Node:
    """The page's tree; ``items`` of a node are texts and nodes, in order."""
    root = here = Node("body", None)
    opened: list[Node] = []             # from the body's child down to ``here``
    places: dict[str, list[int]] = {}   # of a name's open elements in ``opened``

    def innermost(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(names: Iterable[str], stop: Iterable[str] = ()) -> None:
        nonlocal here
        target = innermost(names)
        if target < 0 or innermost(stop) > target:
            return
        here = opened[target].parent
        while len(opened) > target:
            places[opened.pop().name].pop()

    for kind, name, *more in Scanner(page):
        if kind == "text":
            if name:
                here.items.append(name)
            continue
        if name in ("html", "body"):
            continue
        if kind == "close":
            close((name,))
            continue
        given, own_end = more
        if name in CLOSES_P:
            close(("p",), ("table", "td", "th", "button", "object"))
        if name in SIBLINGS:
            own, containers = SIBLINGS[name]
            while True:
                before = here
                close(own, containers)
                if here is before or name not in ("thead", "tbody", "tr"):
                    break
        labels = [] if name in ("article", "main") else [
            t for k in ("class", "id", "role") for t in given.get(k, "").split() if _LABEL_NAME.fullmatch(t)]
        # the header of an article holds its headline
        furniture = name in FURNITURE and not (name == "header" and here.name in ("article", "main")) or any(map(_OTHERS_NAME.search, labels))
        node = Node(name, here, furniture, name in SILENT or hidden(given) or name == "button" and here.block not in TEXT_BLOCKS)
        node.labelled = bool(labels) and not furniture
        here.items.append(node)
        if name in VOID or own_end and name not in INLINE | CLOSES_P | RAW:
            continue
        places.setdefault(name, []).append(len(opened))
        opened.append(node)
        here = node
    return root


def settle(root: Node) -> None:
    """A name makes an element furniture unless the element holds most of the
    body's text outside links and furniture elements, and no article or main
    element stands beside it."""
    order, stack, articles = [], [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        if node.name in ("article", "main"):
            articles.append(node)
        for item in node.items:
            if isinstance(item, str):
                node.plain += len(_SPACE.sub("", item))
            elif not (item.silent or item.furniture or item.name == "a"):
                stack.append(item)
    for node in reversed(order):
        if node.parent is not None:
            node.parent.plain += node.plain
    whole, holds = root.plain, set()      # holds: elements with an article inside or around them
    for node in articles:
        up = node
        while up is not None and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    within, stack = {id(a) for a in articles}, list(articles)
    while stack:
        for item in stack.pop().items:
            if not isinstance(item, str) and id(item) not in within:
                within.add(id(item))
                stack.append(item)
    stack = [root]
    while stack:
        node = stack.pop()
        if node.labelled:
            beside = bool(articles) and id(node) not in holds and id(node) not in within
            node.furniture = beside or 2 * node.plain <= whole
        stack.extend(x for x in node.items if not isinstance(x, str))


def measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes that can be content, parents first."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.furniture or node.name == "a"
        for item in node.items:
            if isinstance(item, str):
                n = len(_SPACE.sub("", item))
                node.chars += n
                node.link_chars += n if linked else 0
            elif not item.silent:
                stack.append((item, linked))
    for node in reversed(order):
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.name == "a" or node.furniture)
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        if node.chars:
            c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
            base = math.log(c * lc / max(c - node.link_chars, 1) + share * c + math.e)
            node.density = c / t * math.log(max(c * t / (lc * lt), 1.0) + 1e-9) / math.log(max(base, 1.0) + 1e-9) if base > 1 + 1e-9 else c / t
    return order


def article(root: Node) -> Node:
    """The subtree that holds the article."""
    settle(root)
    order = measure(root)
    barred: set[int] = set()
    sums: dict[int, float] = {}
    for node in order:
        if node.furniture or id(node.parent) in barred:
            barred.add(id(node))
        elif node.parent is not None:
            sums[id(node.parent)] = sums.get(id(node.parent), 0.0) + node.density
    chosen, best = root, -1.0
    for node in order:
        if id(node) not in barred and node.name not in INLINE and sums.get(id(node), 0.0) > best:
            chosen, best = node, sums.get(id(node), 0.0)
    heart, up = chosen, chosen
    while up is not root:
        if up.density >= root.density:
            heart = up
        up = up.parent
    return heart


def text_of(top: Node) -> str:
    blocks, now = [], []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(now)).split())
        now.clear()
        if text:
            blocks.append(text)

    stack: list = [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            now.append(item)
        elif item is None:
            flush()
        elif item.name == "br":
            now.append(" ")
        elif not (item.silent or item.furniture and item is not top):
            block = item.name not in INLINE
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(item.items))
    flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    return text_of(article(parse(page))) if page else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    keep = [f for f in pages.schema if f.name not in (html_col, "text", "n_chars")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep) + "text string, n_chars bigint"
    names = [f.name for f in keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=[*names, "text", "n_chars"])

    return map_arrow(pages.select(*names, html_col), run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
