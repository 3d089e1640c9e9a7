"""Main text of web pages by scores in the tree.

Every block of text (a paragraph, heading, item, cell or bare text of a container) has points for its
length and its commas. It passes them to its parent in full, to the grandparent by half, then by a
third, a quarter and so on, up to LEVELS containers; a container's points are discounted by the share of its text that
stands inside links. Tags that mean an article or a main part add points, and what is no content by its tag, role
or class has been taken out before. The best container is kept with those siblings that have enough points
themselves or read like running text.

A class that is a word for what is no content takes its element out. A class that only has such a word as a part
("sidebar-left", "tag-python") does so, too, unless another class names content or layout, or nothing would be
left of the page; words for readers' comments always do.

Defined cases: NULL html is empty and gives an empty text; pages without tags are one block; unclosed and
misplaced tags are closed where the next block begins; a page whose blocks are all links or removed gives an
empty text; time grows in proportion to the page, however deep its tree; very long pages are read whole;
repeated rows and other columns make no difference.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Tags that hold no article text.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select input textarea iframe object "
    "embed svg canvas audio video map menu dialog noembed noframes title search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# An opening tag of the keys ends open tags of the values, up to the nearest of BOUND.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "option": {"option"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "thead": {"thead", "tbody", "tr", "td", "th"},
    "body": {"head"},
}
BOUND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE = {"table"}
# The kinds of opening tags that an element matters for, as what they end or as what bounds them.
STARTS: dict[str, list[str]] = {}
for _kind, _ended in ENDS.items():
    for _tag in _ended | BOUND.get(_kind, TABLE):
        STARTS.setdefault(_tag, []).append(_kind)
KEEPS_P = frozenset("caption option optgroup td th tr tbody thead tfoot".split())

# Words of class, id or role that tell what is not the article.
_NOISE_WORDS = (
    r"ad|ads|adv|advert|adverts|advertisement|advertising|banner|breadcrumbs?|comments?|commentary|"
    r"complementary|contentinfo|cookies?|consent|disqus|discussion|footer|gdpr|masthead|menu|menubar|modal|nav|"
    r"navbar|navigation|newsletter|notice|notification|outbrain|pagination|pager|popup|promo|promoted|promotion|"
    r"related|recommended|replies|respond|rss|share|sharing|shoutbox|sidebar|signup|skip|skyscraper|social|sponsor|"
    r"sponsored|subscribe|subscription|taboola|tags?|teaser|toolbar|tooltip|topbar|widget|alert|alertdialog|search|"
    r"toc|login|site-header|disclaimer|paywall|adsense|adslot|adbox|adunit|sidebars|warning"
)
NOISE = re.compile(rf"(?:^|(?<!has)(?<!no)(?<!with)[\s_-])(?:{_NOISE_WORDS})(?:$|[\s_-])", re.I)
NOISE_CLASS = re.compile(_NOISE_WORDS, re.I)
# Readers' comments, unless the word only tells whether there may be any.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentary|disqus|discussion|replies|respond)(?:$|\s|[_-](?!open|closed|enabled|disabled|on\b|off\b))", re.I)
# Classes that name content or its frame.
FRAMES = frozenset(
    "article articles blog body container content entry hentry layout main page post site story text wrap wrapper".split()
)
HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog)(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|"
    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


LEVELS = 64  # containers that a block passes points to


class Node:
    """An element. ``depth`` is its place in the tree; ``stop`` the nearest element, itself included, that an open
    paragraph is looked for in, ``edge`` the depth of the nearest block, ``tops`` the topmost open elements that opening tags end."""

    __slots__ = ("tag", "parent", "children", "gone", "maybe", "marks", "points", "length", "linked", "depth", "stop", "edge", "tops",
                 "in_article", "headed", "kept")

    def __init__(self, tag: str, parent: Node | None, marks: str = "", gone: bool = False, maybe: bool = False):
        self.tag, self.parent, self.marks, self.gone, self.maybe = tag, parent, marks, gone, maybe
        self.children: list[Node | str] = []
        self.points = 0.0
        self.length = self.linked = 0
        self.headed = self.kept = False
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article
        if parent is None:
            self.depth, self.stop, self.edge, self.tops = 0, self, 0, {}
            return
        self.depth = parent.depth + 1
        self.stop = self if tag == "p" or tag in BLOCKS and tag not in HEADINGS else parent.stop
        self.edge = self.depth if tag in BLOCKS else parent.edge
        self.tops = parent.tops
        if tag in STARTS:
            tops = dict(parent.tops)
            for kind in STARTS[tag]:
                if tag in BOUND.get(kind, TABLE):
                    tops[kind] = None
                elif tops.get(kind) is None:
                    tops[kind] = self
            self.tops = tops
        if tag in HEADINGS:
            up = parent
            while up is not None and not up.headed:
                up.headed = True
                up = up.parent


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def _opened(tag: str, source: str, parent: Node) -> Node:
    given = _attributes(source)
    marks = " ".join(given.get(x, "") for x in ("class", "id", "role"))
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I
    )
    noisy = tag not in ("html", "body", "article", "main") and not given.get("role") == "main" and NOISE.search(marks)
    maybe = False
    if noisy and not any(NOISE_CLASS.fullmatch(c) for c in marks.split()):
        comments = COMMENTS.search(marks)
        framed = not comments and any(c.lower() in FRAMES for c in marks.split())
        noisy, maybe = not framed, not framed and not comments
    gone = bool(tag in DROPPED or hidden)
    return Node(tag, parent, marks, gone or bool(noisy), maybe and not gone)


def parse(html: str, nodes: list[Node] | None = None) -> Node:
    """Tree of a page. Raw elements hold their source; texts have their references decoded. ``nodes`` gets all
    elements in the order of their beginnings."""
    root = node = Node("#root", None)
    nodes = [] if nodes is None else nodes
    nodes.append(root)
    opened: dict[str, list[Node]] = {}  # of each tag the open elements, outermost first

    def up_to(target: Node) -> Node:
        while node_at[0] is not target:
            opened[node_at[0].tag].pop()
            node_at[0] = node_at[0].parent
        return target

    node_at = [root]
    at, size, lower = 0, len(html), None
    while at < size:
        m = TOKEN.search(html, at)
        if m is None:
            node.children.append(unescape(html[at:]))
            break
        if m.start() > at:
            node.children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            node = up_to(_make_room(node, tag))
            new = _opened(tag, m[3], node)
            node.children.append(new)
            nodes.append(new)
            if tag in RAW:
                lower = lower or html.lower()
                end = lower.find(f"</{tag}", at)
                at = size if end < 0 else end
            if tag in RAW or tag not in VOID:
                opened.setdefault(tag, []).append(new)
                node = node_at[0] = new
        elif m[1]:
            node = up_to(_close(node, m[1].lower(), opened))
        elif m[0].startswith("<![CDATA["):
            node.children.append(m[0][9:].removesuffix("]]>"))
    return root


def _make_room(node: Node, tag: str) -> Node:
    """Ends what an opening tag ends: an open paragraph before a block, an item before an item."""
    if tag in BLOCKS and tag not in KEEPS_P and node.stop.tag == "p":
        node = node.stop.parent
    if tag in ENDS:
        last = node.tops.get(tag)
        if last is not None:
            node = last.parent
    return node


def _close(node: Node, tag: str, opened: dict[str, list[Node]]) -> Node:
    """An end tag without a beginning is passed over; one inside a block doesn't end what is around it,
    unless it is a block itself."""
    same = opened.get(tag)
    if not same or tag not in BLOCKS and same[-1].depth <= node.edge:
        return node
    return same[-1].parent


def _kept_header(node: Node) -> bool:
    """A header inside an article that has its heading is part of it."""
    return node.headed and node.parent is not None and node.parent.in_article


class _Block:
    __slots__ = ("owner", "parts", "linked")

    def __init__(self, owner: Node):
        self.owner, self.parts, self.linked = owner, [], 0


def blocks(root: Node) -> list[tuple[Node, str, int]]:
    """(innermost block element, text, characters of it inside links) in page order, removed parts left out."""
    found: list[tuple[Node, str, int]] = []
    current = _Block(root)

    def finish(owner: Node) -> _Block:
        text = " ".join("".join(current.parts).split())
        if text:
            found.append((current.owner, text, min(current.linked, len(text))))
        return _Block(owner)

    stack: list[tuple[Node | str, Node, bool, bool]] = [(root, root, False, False)]
    while stack:
        item, owner, linked, leaving = stack.pop()
        if isinstance(item, str):
            current.parts.append(item)
            if linked:
                current.linked += len(" ".join(item.split()))
            continue
        if leaving:
            current = finish(owner)
            continue
        header = item.tag == "header" or item.tag not in ("html", "body") and HEADER.search(item.marks)
        if item.gone or header and not _kept_header(item):
            current.parts.append(" ")
            continue
        if item.tag == "br":
            current.parts.append("\n")
            continue
        inside = item if item.tag in BLOCKS or item.tag == "#root" else owner
        if inside is item:
            current = finish(item)
            stack.append((item, owner, linked, True))
        within = linked or item.tag == "a"
        stack.extend((child, inside, within, False) for child in reversed(item.children))
    finish(root)
    return found


def _points(text: str) -> float:
    """One point, one for each comma, one for each hundred characters up to three; short blocks have less."""
    commas = sum(text.count(c) for c in ",،、，")
    return min(1.0, len(text) / 25) + commas + min(len(text) / 100, 3.0)


PARAGRAPHS = frozenset("p pre blockquote li dd dt td th figcaption caption summary h1 h2 h3 h4 h5 h6".split())


def main_text(html: str) -> str:
    """Blocks of the article, joined by line breaks."""
    nodes: list[Node] = []
    root = parse(html, nodes)
    text = _best_text(root, nodes)
    if not text and any(n.maybe for n in nodes):
        for n in nodes:
            n.gone = n.gone and not n.maybe
            n.points, n.length, n.linked, n.kept = 0.0, 0, 0, False
        text = _best_text(root, nodes)
    return text


def score(found: list[tuple[Node, str, int]], nodes: list[Node]) -> list[Node]:
    """Gives the elements their points, and the lengths of their text; those with points, nearest to their blocks first."""
    scored: dict[int, Node] = {}
    for owner, text, linked in found:
        value = _points(text) * (1 - linked / len(text))
        holder = owner.parent if owner.tag in PARAGRAPHS and owner.parent else owner
        holder.length += len(text)
        holder.linked += linked
        share, up = 1, holder
        while up is not None and share <= LEVELS:
            up.points += value / share
            scored[id(up)] = up
            share += 1
            up = up.parent
    for node in reversed(nodes):  # children come after their parents
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    for node in scored.values():
        if node.tag in ("article", "main"):
            node.points = node.points * 2 + 25
        elif ARTICLE.search(node.marks):
            node.points = node.points * 1.25 + 5
        node.points *= 1 - node.linked / max(node.length, 1)
    return list(scored.values())


def _best_text(root: Node, nodes: list[Node]) -> str:
    found = blocks(root)
    if not found:
        return ""
    scored = score(found, nodes)
    best = max(scored, key=lambda n: n.points)  # the first of equals
    most = best.points
    if most <= 0:
        return ""
    best.kept = True
    if best.parent is not None and best.tag not in ("html", "body", "#root"):
        with_points = {id(n) for n in scored}
        for sibling in best.parent.children:
            if not isinstance(sibling, Node) or sibling is best or id(sibling) not in with_points:
                continue
            running = sibling.length >= 80 and sibling.linked / sibling.length < 0.25 and sibling.tag in PARAGRAPHS
            enough = sibling.points >= max(10.0, 0.2 * most)
            if best.tag in ("article", "main"):
                enough = enough and sibling.tag in ("article", "main", "section")
                running = False
            if enough or running:
                sibling.kept = True
    if best.parent is not None and best.tag not in ("article", "main"):
        for heading in _headings_before(best):
            heading.kept = True
    for node in nodes:  # parents come before their children
        node.kept = node.kept or node.parent is not None and node.parent.kept
    whole = best.tag in ("body", "html", "#root")
    return "\n".join(
        text for owner, text, linked in found
        if owner.kept and not (whole and linked == len(text) and owner.tag in ("li", "td"))
    )


def _headings_before(best: Node) -> list[Node]:
    """The heading that stands right before the best container."""
    before = None
    for sibling in best.parent.children:
        if sibling is best:
            break
        if isinstance(sibling, Node) and not sibling.gone:
            before = sibling
    return [before] if before is not None and before.tag in HEADINGS else []


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The columns ``keep``, ``text`` and ``n_chars`` of every page."""
    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h or "") for h in part.column(part.num_columns - 1).to_pylist()]
                columns = [part.column(i) for i in range(len(keep))]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    source = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html).cast("string").alias("_html_of_row"))
    return source.mapInArrow(run, f"{kept}, text string, n_chars long")
