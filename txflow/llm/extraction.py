"""Main text of web pages by tree scoring.

Each page is parsed into a small tree. Paragraphs pass points for their length and commas to
their ancestors, which lose by the share of their text inside links; the best container and
those siblings that look alike are kept, without menus, adverts, forms, notices and comments.

What an element is (a form, a hidden one) settles that it is left out. A name in its class or id does
not: it is only taken at its word where the element does not hold the article or nearly all
text, and a word that also occurs in articles only where it holds no paragraph of theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txflow.llm.common import texts_in_bites

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")

# Elements of HTML by their role in the text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math object canvas audio video select".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NEVER = frozenset("nav header footer aside form button dialog menu fieldset head label input".split())
_ROLES = frozenset("navigation banner contentinfo complementary dialog alert alertdialog search menu menubar form".split())
_NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner cookie cookies "
    "consent gdpr notice notification alert newsletter subscribe subscription signup login paywall sidebar menu navbar nav "
    "navigation breadcrumb breadcrumbs share sharing social related recommended recommendations teaser comment comments "
    "commentlist disqus discussion reply replies respond popup modal overlay header masthead footer pagination pager skip "
    "widget toolbar tags meta byline copyright legal disclaimer".split()
)
#: Of those, names that parts of an article have as well.
_VAGUE = frozenset("notice banner discussion header legal meta tags widget toolbar reply replies disclaimer promotion respond".split())
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_UNMEANT = frozenset("has with no without".split())
#: An opening tag on the left ends an open element on the right.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}


class _Node:
    __slots__ = ("tag", "parent", "children", "noise", "named", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, noise: bool, named: int = 0):
        self.tag, self.parent, self.noise, self.named = tag, parent, noise, named
        self.children: list[_Node | str] = []
        self.points = 0.0
        self.chars = self.linked = 0


_BY_NAME, _BY_VAGUE_NAME = 2, 1


def _is_noise(tag: str, attrs: str) -> tuple[bool, int]:
    """Whether the element is left out, and else whether a name says that it should be."""
    if tag in _NEVER:
        return True, 0
    if not attrs or tag in ("html", "body", "main", "article"):
        return False, 0
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in _ROLES:
        return True, 0
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, 0
    named = 0
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [x.lower() for x in _SPLIT.split(name) if x]
        if parts and parts[0] not in _UNMEANT:
            meant = _NOISE.intersection(parts)
            named = max(named, _BY_NAME if meant - _VAGUE else _BY_VAGUE_NAME if meant else 0)
    return False, named


def _tree(html: str) -> _Node:
    root = _Node("html", None, False)
    at, pos, end = root, 0, len(html)
    unclosed: set[str] = set()  # names without another end tag
    while pos < end:
        m = _TAG.search(html, pos)
        if m is None:
            at.children.append(html[pos:])
            break
        if m.start() > pos:
            at.children.append(html[pos : m.start()])
        pos = m.end()
        name = m["name"]
        if name is None:
            if m["cdata"]:
                at.children.append(m["cdata"].replace("&", "&amp;"))
            continue
        name = name.lower()
        if m["end"]:
            up = at
            while up is not root and up.tag != name:
                # An inline end tag does not close the block around it.
                up = root if up.tag in _BLOCKS and name not in _BLOCKS else up.parent
            if up is not root:
                at = up.parent
            continue
        if name in _RAW:
            if not m["attrs"].endswith("/") or name in ("script", "style", "textarea", "title"):
                closing = None
                if name not in unclosed:
                    closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, pos)
                if closing is None:
                    unclosed.add(name)
                pos = closing.end() if closing else (end if name in ("script", "style") else pos)
            continue
        if name in ("html", "body"):
            if not at.noise:
                at.noise = False
            continue
        if name in _VOID:
            at.children.append("\n" if name == "br" else " ")
            if name == "hr":
                at.children.append(_Node("hr", at, False))
            continue
        if name in _BLOCKS:
            ends = _ENDS.get(name, frozenset())
            up = at
            while up is not root and (up.tag not in _BLOCKS or up.tag == "p" or up.tag in ends):
                if up.tag == "p" or up.tag in ends:
                    at = up.parent
                up = up.parent
        node = _Node(name, at, *_is_noise(name, m["attrs"]))
        at.children.append(node)
        if not m["attrs"].endswith("/"):
            at = node
    _judge_names(root)
    return root


#: A paragraph of an article has so many characters, and less than so much of them in links.
_PARAGRAPH, _LINKED = 80, 0.25


def _judge_names(root: _Node) -> None:
    """Leave out elements whose names say so, unless what they hold says otherwise: an article, nearly
    all text of the page, or, for vague names inside an article, a paragraph of it."""
    chars: dict[int, int] = {}
    holds: dict[int, int] = {}  # 1: a paragraph, 2: an article
    links: dict[int, int] = {}
    order: list[tuple[_Node, bool]] = []
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        order.append((node, inside))
        within = inside or node.tag in ("article", "main")
        stack += [(c, within) for c in node.children if isinstance(c, _Node) and not c.noise]
    if not any(node.named for node, _ in order):
        return
    for node, _ in reversed(order):
        own = [c for c in node.children if isinstance(c, _Node) and not c.noise]
        n = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(chars[id(c)] for c in own)
        linked = n if node.tag == "a" else sum(links[id(c)] for c in own)
        chars[id(node)], links[id(node)] = n, linked
        what = max((holds[id(c)] for c in own), default=0)
        if node.tag in ("article", "main"):
            what = 2
        elif node.tag in ("p", "pre", "blockquote") and n >= _PARAGRAPH and linked < _LINKED * n:
            what = max(what, 1)
        holds[id(node)] = what
    for node, inside in order:
        if node.named:
            spared = holds[id(node)] == 2 or chars[id(node)] >= 0.9 * chars[id(root)]
            spared = spared or (inside and node.named == _BY_VAGUE_NAME and holds[id(node)] == 1)
            node.noise = not spared


def _blocks(top: _Node) -> list[tuple[_Node, str, int]]:
    """(block, its own text, characters of it inside links) in page order, noise left out."""
    out: list[tuple[_Node, str, int]] = []
    pieces: list[str] = []
    linked = 0
    owner = top

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", unescape("".join(pieces))).strip()
        if text:
            out.append((owner, text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    stack: list[tuple[_Node, Iterator, bool]] = [(top, iter(top.children), False)]
    while stack:
        node, rest, link = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if node.tag in _BLOCKS:
                flush()
                owner = next((s[0] for s in reversed(stack) if s[0].tag in _BLOCKS), top)
        elif isinstance(child, str):
            pieces.append(child)
            linked += len(child.strip()) if link else 0
        elif not child.noise:
            if child.tag in _BLOCKS:
                flush()
                owner = child
            stack.append((child, iter(child.children), link or child.tag == "a"))
    flush()
    return out


_SHORT = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())


def _chain(node: _Node) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def main_text(html: str | None) -> str:
    """Main text of one page: its blocks joined by line ends; empty if there is none."""
    if not html:
        return ""
    root = _tree(html)
    blocks = _blocks(root)
    if not blocks:
        return ""
    for node, text, linked in blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
        for level, up in enumerate(_chain(node)):
            up.chars += len(text)
            up.linked += linked
            if level == 0 and node.tag not in ("p", "pre", "li", "td", "dd", "h1", "h2", "h3", "h4", "h5", "h6"):
                up.points += points
            elif level:
                up.points += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
    score = lambda n: n.points * (1 - n.linked / n.chars) if n.chars else 0.0
    seen: dict[int, _Node] = {}
    for node, _, _ in blocks:
        for up in _chain(node):
            if id(up) in seen:
                break
            seen[id(up)] = up
    scored = [n for n in seen.values() if n.tag in _BLOCKS]
    best = max(scored, key=score)
    # An article holds its sections, whichever of them scores best.
    outer = [n for n in _chain(best) if n.tag == "article"] or [n for n in _chain(best) if n.tag == "main"]
    kept = {id(outer[-1] if outer else best)}
    top = outer[-1] if outer else best
    if top.parent is not None:
        enough = max(1.0, score(top) * 0.2)
        beside = [c for c in top.parent.children if isinstance(c, _Node) and c.chars and not c.noise]
        plain = [c.linked < _LINKED * c.chars for c in beside]
        own = [i for i, c in enumerate(beside) if c is top]
        for i, sibling in enumerate(beside):
            good = score(sibling) >= enough or sibling.tag == "p" and sibling.chars > _PARAGRAPH
            if good and plain[i]:
                own.append(i)
        first, last = min(own), max(own)
        # Headings and short paragraphs between those, and right before the first.
        while first and plain[first - 1] and beside[first - 1].tag in _SHORT:
            first -= 1
        own += [i for i in range(first, last) if plain[i] and beside[i].tag in _SHORT]
        kept.update(id(beside[i]) for i in own)
    lines = []
    for node, text, linked in blocks:
        chain = list(_chain(node))
        inside = next((i for i, up in enumerate(chain) if id(up) in kept), None)
        if inside is None:
            continue
        lists = [up for up in chain[: inside + 1] if up.tag in ("ul", "ol")]
        if lists and lists[-1].linked > 0.75 * lists[-1].chars and not (lines and any(up.tag == "article" for up in chain)):
            continue  # a list of links is a menu, unless an article goes on with it
        lines.append(text)
    return "\n".join(lines)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url and text of each row of ``pages`` (page_id, url, html; others ignored).

    Null or empty html, and pages without text, give an empty text; repeated rows stay. Pages
    are independent of each other: one pass, no shuffle. Broken markup is read as browsers
    do: open paragraphs, list items and cells end where the next one begins, stray end tags
    are skipped, comments and scripts may be cut off by the end of the page.
    """
    schema = T.StructType(
        [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())]
    )
    columns = ["page_id", "url", "html"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "html"):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([main_text(t) for t in texts], pa.string())],
                ["page_id", "url", "text"],
            )

    return pages.select(*columns).mapInArrow(run, schema)
