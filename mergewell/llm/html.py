"""HTML extraction: paragraphs score their ancestors, the best container is kept."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is never part of an article.
DROPPED = frozenset("head title script style noscript template nav header footer aside form button select option textarea input iframe object embed svg canvas audio video map dialog menu".split())
#: Elements whose content is raw text up to the closing tag.
RAW = frozenset("script style noscript template textarea title iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a run of text.
BLOCKS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary center fieldset hgroup search".split()) | DROPPED
#: What an opening tag closes, if that is the innermost open block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Words in class, id or role that mark furniture, and those that outweigh them.
FURNITURE = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar sidebar aside rail footer foot header masthead "
    "comment comments disqus respond replies cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations breadcrumb breadcrumbs pagination pager toolbar widget tagline tags hidden complementary contentinfo search".split()
)
ARTICLE = frozenset("article main content entry story body".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|$)|</?[a-zA-Z][^>]*$", re.S)
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z0-9]+(?:[-_]+[a-z0-9]+)*")
_WORD = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$|=)")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "score", "chars", "linked", "good")

    def __init__(self, tag: str, parent: Node | None, drop: bool, good: bool) -> None:
        self.tag, self.parent, self.drop, self.good = tag, parent, drop, good
        self.children: list[Node | Block] = []
        self.score, self.chars, self.linked = 0.0, 0, 0

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


class Block:
    __slots__ = ("text", "linked")

    def __init__(self, text: str, linked: int) -> None:
        self.text, self.linked = text, linked


def _furniture(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether it declares itself an article.

    A class, id or role like ``ad-slot`` or ``post-comments`` begins or ends
    with a word for furniture; ``has-sidebar`` only speaks of it. One like
    ``main-content`` beside it keeps the element.
    """
    if "=" not in attributes and "hidden" not in attributes:
        return tag in DROPPED, tag in ("article", "main")
    found = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    good = tag in ("article", "main") or found.get("role") in ("main", "article") or found.get("itemprop") == "articleBody"
    hidden = found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "") or _HIDDEN.search(attributes) is not None
    furniture = article = False
    for name in _NAME.findall(_HUMP.sub("-", " ".join(found.get(k, "") for k in ("class", "id", "role"))).lower()):
        words = _WORD.findall(name) or [""]
        if words[0] in FURNITURE or words[-1] in FURNITURE and words[0] not in ("has", "with", "no", "is", "without"):
            furniture = True
        elif words[-1] in ARTICLE:
            article = True
    return tag in DROPPED or hidden or furniture and not article and tag not in ("html", "body", "main"), good


def tree(page: str) -> Node:
    """Blocks of text in a tree of block elements; unclosed elements end with their parent."""
    root = here = Node("#", None, False, False)
    text: list[str] = []
    spans: list[int] = []  # characters of pieces that are links
    links, at = 0, 0
    skipped, depth = "", 0  # the inline element of furniture that is open, and how deep it is nested in itself

    def flush() -> None:
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                here.children.append(Block(whole, min(len(whole), sum(spans))))
            text.clear()
            spans.clear()

    def add(piece: str) -> None:
        if piece and not depth:
            text.append(piece)
            if links:
                spans.append(len(" ".join(entities.unescape(piece).split())))

    n, token = len(page), _TOKEN.search
    while m := token(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if depth and tag not in RAW:
            if tag == skipped:
                depth += -1 if m[1] else 1
                continue
            if tag not in BLOCKS:
                continue
            depth = 0  # one that was never closed ends with its paragraph
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                flush()
                node: Node | None = here
                while node is not None and node.tag != tag:
                    node = node.parent
                if node is not None and node.parent is not None:
                    here = node.parent
            elif tag == "br":
                add(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            if tag in BLOCKS:
                flush()
            continue
        if tag in ("br", "hr", "wbr"):
            if tag == "hr":
                flush()
            elif tag == "br":
                add(" ")
        elif tag == "a":
            links = 1
        elif tag in BLOCKS:
            flush()
            links = 0
            if here.tag == "p":
                here = here.parent or root
            while here.tag in CLOSES.get(tag, ()):
                here = here.parent or root
            if tag not in VOID:
                drop, good = _furniture(tag, m[3])
                child = Node(tag, here, drop, good)
                here.children.append(child)
                here = child
        elif m[3] and tag in _INLINE and _furniture(tag, m[3])[0]:
            skipped, depth = tag, 1
    add(page[at:])
    flush()
    return root


_INLINE = frozenset("span ins small strong em b i u mark sup sub label font cite abbr time".split())


def _weigh(node: Node) -> None:
    """Sums characters upwards; paragraphs pass points to their ancestors."""
    stack = [(node, iter(node.children))]
    while stack:
        here, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if stack:
                stack[-1][0].chars += here.chars
                stack[-1][0].linked += here.linked
        elif isinstance(child, Node):
            if not child.drop:
                stack.append((child, iter(child.children)))
        else:
            here.chars += len(child.text)
            here.linked += child.linked
            if len(child.text) >= 25:
                points = (1 + child.text.count(",") + min(len(child.text) / 100, 3)) * (1 - child.linked / len(child.text))
                # a block element with own text is the paragraph; its parent is the first ancestor
                node_up = here.parent if here.tag in _LEAVES and here.parent is not None else here
                share = 1.0
                while node_up is not None:
                    node_up.score += points * share
                    share = share / 2 if share == 1 else share * 2 / 3
                    node_up = node_up.parent


_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption address summary".split())


def _nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.drop]


def _above(node: Node, top: Node) -> Iterator[Node]:
    """The ancestors of a node below ``top``."""
    up = node.parent
    while up is not None and up is not top:
        yield up
        up = up.parent


def _belongs(beside: Node | Block, least: float, article: bool, before: bool) -> bool:
    """Whether what stands beside the best container is part of the text.

    Beside one that declares itself an article only headings before it and other
    such elements with a score are; beside others also paragraphs with few links.
    """
    if isinstance(beside, Block):
        return not article and len(beside.text) >= 25 and beside.linked < 0.25 * len(beside.text)
    if beside.drop:
        return False
    scores = beside.score * (1 - beside.density()) >= least
    plain = beside.chars > 0 and beside.density() < 0.25
    if article:
        return beside.good and scores or before and plain and beside.tag in ("h1", "h2", "hgroup")
    return scores or plain and beside.tag in _LEAVES


def _reply(node: Node) -> bool:
    """An article within an article that has text of its own: a reader's comment or another article's teaser."""
    if node.tag != "article":
        return False
    up = node.parent
    while up is not None and up.tag != "article":
        up = up.parent
    return up is not None and up.chars - sum(x.chars for x in _inner(up)) >= 25


def _inner(article: Node) -> Iterator[Node]:
    """The articles directly within an article, however deep."""
    stack = [c for c in article.children if isinstance(c, Node) and not c.drop]
    while stack:
        x = stack.pop()
        if x.tag == "article":
            yield x
        else:
            stack += [c for c in x.children if isinstance(c, Node) and not c.drop]


def extract(page: str | None) -> str:
    """The blocks of the best container and of its kept siblings, joined by two line ends.

    A paragraph's points are 1, one for each comma and up to 3 for length;
    its parent gets all of them, the next ancestor half, each further one two
    thirds of the one below. A container's score is discounted by the share of
    its characters in links. The best one grows to an enclosing article or
    main element. Of its siblings those stay that score a fifth of it, or that
    are paragraphs or bare text with few links; beside an article only others
    that score, and headings before it. Articles within an article are replies.
    """
    root = tree(page or "")
    _weigh(root)
    nodes = list(_nodes(root))
    best = max(nodes, key=lambda x: x.score * (1 - x.density()))
    if not best.score:
        best = next((x for x in nodes if x.good and x.chars), root)
    up: Node | None = best
    while up is not None:
        if up.good:
            best = up
        up = up.parent
    if not best.good:  # a wrapper of declared articles
        inside = [x for x in _nodes(best) if x.good and x.score]
        if sum(x.chars for x in inside if not any(y is not x and y.good for y in _above(x, best))) >= 0.5 * best.chars and inside:
            best = max(inside, key=lambda x: x.score * (1 - x.density()))
    kept: list[Node | Block] = [best]
    if best.parent is not None:
        least = max(5.0, best.score * (1 - best.density()) / 5)
        beside = best.parent.children
        before = beside.index(best)
        kept = [s for k, s in enumerate(beside) if s is best or _belongs(s, least, best.good, k < before)]
    out: list[str] = []
    for top in kept:
        stack: list[Node | Block] = [top]
        while stack:
            x = stack.pop()
            if isinstance(x, Block):
                out.append(x.text)
            elif x is top or not x.drop and not _reply(x):
                stack += reversed(x.children)
    return "\n\n".join(out)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` → ``page_id, url, text``, where the rows are read.

    Null or empty html gives an empty text; repeated rows are extracted as
    often as they come; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(part.column(2)[k].as_py()) for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url {pages.schema['url'].dataType.simpleString()}, text string")
