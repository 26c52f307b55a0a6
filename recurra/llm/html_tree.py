"""Reading HTML: a forgiving parser that makes trees of elements, and the blocks of text in them. No Spark in here."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import xxhash

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # A quote opens a value only after an equals sign; where that leaves none to close it, the tag ends at the next bracket.
    r"|<(?P<raw>script|style|textarea)\b(?:(?:[^<>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])))*+|[^<>]*+)>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<attributes>(?:[^<>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])))*+|[^<>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NAME_PART = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# A start tag of the key ends the nearest open element of the values, unless one of the third column stands between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_NO_PARAGRAPH = frozenset("li dd dt tr td th thead tbody tfoot body html head figcaption legend summary".split())

# Elements that are no part of a page's text. What stands in them is read, so that an unclosed one ends with its parent, and left out.
_DROPPED = frozenset("noscript template iframe svg select title annotation annotation-xml".split())
# A block's start tag ends those of them that cannot hold one, unless an element of the second set stands between.
_HOLD_NO_BLOCK = frozenset("svg select title".split())
_HOLD_BLOCKS = frozenset("foreignobject desc noscript template iframe annotation-xml".split())

NOISE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe signup share sharing social related recommended recommendations sidebar widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment comments disqus respond replies search login".split()
)


# Words that may stand beside one of those in a name of one part of a page (site-header, comment-list); with any other word (ad-hoc, entry-header) a
# name says something else.
_BESIDE = frozenset(
    "site page main global top bottom left right inner outer primary secondary sticky fixed floating box bar block section list wrapper wrap container area "
    "slot unit link links button buttons icon icons item items form field panel group content text title row col column inline image img video google dfp "
    "post posts article articles story stories news email mail policy banner message msg the and of user users".split()
)
# Sites make ids of the text of titles and sections. So titles and paragraphs are never left out for an id, and inside an article only these ids count.
_NEVER_BY_ID = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre".split())
_IDS_IN_ARTICLES = frozenset("ad ads advert adverts advertisement comment comments disqus respond replies newsletter sidebar".split())


def _is_noise_name(name: str) -> bool:
    """Whether a whole class or id name, cut at its hyphens, says that an element is no article text."""
    parts = _NAME_PART.findall(name)
    return not NOISE_NAMES.isdisjoint(parts) and all(part in NOISE_NAMES or part in _BESIDE for part in parts)


class Node:
    """An element: its children are texts and elements. `path` names its place in the site's style tree. `in_article` says whether it stands in one."""

    __slots__ = ("tag", "looks", "noise", "children", "path", "parent", "in_article")

    def __init__(self, tag: str, looks: str, noise: bool, parent: Node | None) -> None:
        self.tag, self.looks, self.noise, self.parent = tag, looks, noise, parent
        self.in_article = parent is not None and (parent.in_article or parent.tag in ("article", "main"))
        self.children: list[Node | str] = []
        self.path = xxhash.xxh64_intdigest(f"{tag} {looks}", parent.path if parent else 0)


def _looks(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """What an element looks like (its class and id names, numbers left out), and whether its names say that it is no article text."""
    noise = tag in NOISE_TAGS
    if not attributes or attributes.isspace():
        return "", noise
    names: list[str] = []
    for match in _ATTRIBUTE.finditer(attributes):
        key = match[1].lower()
        if key in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            value = html.unescape(match[2] or match[3] or match[4] or "").lower()
            parts = _NAME_PART.findall(value)
            if key in ("class", "id"):
                names += parts
                if key == "class" or tag not in _NEVER_BY_ID and not in_article:
                    noise = noise or any(map(_is_noise_name, value.split()))
                elif tag not in _NEVER_BY_ID:
                    noise = noise or value.strip() in _IDS_IN_ARTICLES
            elif key == "role":
                noise = noise or value.strip() in NOISE_ROLES
            else:
                noise = noise or key == "hidden" or key == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", "")
    return " ".join(names), noise


class _Open:
    """The elements that are open, and how many of each tag, so that nobody looks for one that is not there."""

    def __init__(self, root: Node) -> None:
        self.stack, self.counts = [root], Counter()

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.counts[node.tag] += 1

    def cut(self, at: int) -> None:
        for node in self.stack[at:]:
            self.counts[node.tag] -= 1
        del self.stack[at:]

    def has(self, tags: frozenset[str] | set[str]) -> bool:
        return any(self.counts[tag] for tag in tags)

    def close(self, ends: frozenset[str] | set[str], unless: frozenset[str] | set[str]) -> None:
        """Ends the nearest open element among `ends`, and what is open inside it."""
        if not self.has(ends):
            return
        stack = self.stack
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in ends:
                self.cut(at)
                return
            if stack[at].tag in unless or stack[at].tag in _DROPPED:
                return

    def leave(self) -> None:
        """Ends the outermost open element that cannot hold a block."""
        if not self.has(_HOLD_NO_BLOCK):
            return
        outermost = 0
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in _HOLD_BLOCKS:
                break
            if self.stack[at].tag in _HOLD_NO_BLOCK:
                outermost = at
        if outermost:
            self.cut(outermost)


_PARAGRAPH = frozenset("li dd dt tr td th thead tbody tfoot body html head figcaption legend summary".split())

# Elements that are no part of a page's text. What stands in them is read, so that an unclosed one ends with its parent, and left out.
_DROPPED = frozenset("noscript template iframe svg select title annotation annotation-xml".split())
# A block's start tag ends those of them that cannot hold one, unless an element of the second set stands between.
_HOLD_NO_BLOCK = frozenset("svg select title".split())
_HOLD_BLOCKS = frozenset("foreignobject desc noscript template iframe annotation-xml".split())

NOISE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe signup share sharing social related recommended recommendations sidebar widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment comments disqus respond replies search login".split()
)


# Words that may stand beside one of those in a name of one part of a page (site-header, comment-list); with any other word (ad-hoc, entry-header) a
# name says something else.
_BESIDE = frozenset(
    "site page main global top bottom left right inner outer primary secondary sticky fixed floating box bar block section list wrapper wrap container area "
    "slot unit link links button buttons icon icons item items form field panel group content text title row col column inline image img video google dfp "
    "post posts article articles story stories news email mail policy banner message msg the and of user users".split()
)
# What an id of its own text may be given to: a title or a paragraph is never left out for a name.
_NEVER_NAMED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre article main".split())


def _is_noise_name(name: str) -> bool:
    """Whether a whole class or id name, cut at its hyphens, says that an element is no article text."""
    parts = _NAME_PART.findall(name)
    return not NOISE_NAMES.isdisjoint(parts) and all(part in NOISE_NAMES or part in _BESIDE for part in parts)


class Node:
    """An element: its children are texts and elements. `path` names its place in the site's style tree. `in_article` says whether it stands in one."""

    __slots__ = ("tag", "looks", "noise", "children", "path", "parent", "in_article")

    def __init__(self, tag: str, looks: str, noise: bool, parent: Node | None) -> None:
        self.tag, self.looks, self.noise, self.parent = tag, looks, noise, parent
        self.in_article = parent is not None and (parent.in_article or parent.tag in ("article", "main"))
        self.children: list[Node | str] = []
        self.path = xxhash.xxh64_intdigest(f"{tag} {looks}", parent.path if parent else 0)


def _looks(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """What an element looks like (its class and id names, numbers left out), and whether its names say that it is no article text."""
    noise = tag in NOISE_TAGS
    if not attributes or attributes.isspace():
        return "", noise
    names: list[str] = []
    for match in _ATTRIBUTE.finditer(attributes):
        key = match[1].lower()
        if key in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            value = html.unescape(match[2] or match[3] or match[4] or "").lower()
            parts = _NAME_PART.findall(value)
            if key in ("class", "id"):
                names += parts
                if key == "class" or tag not in _NEVER_BY_ID and not in_article:
                    noise = noise or any(map(_is_noise_name, value.split()))
                elif tag not in _NEVER_BY_ID:
                    noise = noise or value.strip() in _IDS_IN_ARTICLES
            elif key == "role":
                noise = noise or value.strip() in NOISE_ROLES
            else:
                noise = noise or key == "hidden" or key == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", "")
    return " ".join(names), noise


def _close(stack: list[Node], ends: set[str] | frozenset[str], unless: set[str] | frozenset[str]) -> None:
    """Ends the nearest open element among `ends`, and what is open inside it."""
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].tag in ends:
            del stack[at:]
            return
        if stack[at].tag in unless or stack[at].tag in _DROPPED:
            return


def _leave(stack: list[Node]) -> None:
    """Ends the outermost open element that cannot hold a block."""
    outermost = 0
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].tag in _HOLD_BLOCKS:
            break
        if stack[at].tag in _HOLD_NO_BLOCK:
            outermost = at
    if outermost:
        del stack[outermost:]


_PARAGRAPH = frozenset(["p"])
_PARAGRAPH_SCOPE = frozenset("td th table button caption html body".split())


def parse(text: str) -> Node:
    """The tree of a page. Every text is a page; tags that do not fit are passed over."""
    root = Node("", "", False, None)
    open_, at = _Open(root), 0
    stack = open_.stack
    for match in _TOKEN.finditer(text):
        start = match.start()
        if start > at:
            stack[-1].children.append(text[at:start])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["end"]:
            if open_.counts[tag]:
                through = tag in BLOCK or tag in _DROPPED
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place].tag == tag:
                        open_.cut(place)
                        break
                    if not through and stack[place].tag in BLOCK:
                        break
            continue
        if tag in BLOCK and tag != "hr":
            open_.leave()
        if tag in BLOCK and tag not in _NO_PARAGRAPH:
            open_.close(_PARAGRAPH, _PARAGRAPH_SCOPE)
        if tag in _ENDS:
            open_.close(*_ENDS[tag])
        attributes, inside = match["attributes"], stack[-1]
        looks, noise = _looks(tag, attributes, inside.in_article or inside.tag in ("article", "main")) if attributes else ("", tag in NOISE_TAGS)
        node = Node(tag, looks, noise, inside)
        if tag not in _DROPPED:
            inside.children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            open_.push(node)
    if at < len(text):
        stack[-1].children.append(text[at:])
    return root


def elements(root: Node) -> Iterator[Node]:
    """All elements in page order."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(c for c in reversed(node.children) if isinstance(c, Node))


def blocks(root: Node, skip: frozenset[int] | set[int] = frozenset()) -> Iterator[tuple[Node, str]]:
    """(element, text) of the blocks below an element, in page order, without elements whose id() is in `skip`.

    A block is the text between the edges of block elements; line breaks and inline elements are part of it. The element is
    the block element around the text.
    """
    parts: list[str] = []
    owner = root
    waiting: list[tuple[Node, int]] = [(root, 0)]

    def finished() -> str:
        whole = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        return whole

    while waiting:
        node, number = waiting.pop()
        if number == 0 and node.tag in BLOCK or number < 0:
            if parts and (whole := finished()):
                yield owner, whole
            if number < 0:
                owner = node
                continue
            owner = node
        children = node.children
        while number < len(children):
            child = children[number]
            number += 1
            if isinstance(child, str):
                parts.append(child)
            elif id(child) in skip:
                if child.tag in BLOCK and parts and (whole := finished()):
                    yield owner, whole
            elif child.tag in VOID:
                if child.tag == "hr":
                    if parts and (whole := finished()):
                        yield owner, whole
                else:
                    parts.append(" " if child.tag == "br" else "")
            else:
                waiting.append((node, number))
                if child.tag in BLOCK:
                    waiting.append((owner, -1))
                waiting.append((child, 0))
                break
    if parts and (whole := finished()):
        yield owner, whole


def main_elements(root: Node) -> list[Node]:
    """The elements that hold the article: the outermost article elements, else main elements, else the body or the whole page."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    waiting: list[tuple[Node, frozenset[str]]] = [(root, frozenset())]
    while waiting:
        node, inside = waiting.pop()
        if node.tag in found and node.tag not in inside:
            if node.tag == "body" or not node.noise:
                found[node.tag].append(node)
            inside = inside | {node.tag}
        for child in reversed(node.children):
            if isinstance(child, Node) and child.tag not in NOISE_TAGS:
                waiting.append((child, inside))
    for tag in ("article", "main", "body"):
        if found[tag]:
            return found[tag]
    return [root]
