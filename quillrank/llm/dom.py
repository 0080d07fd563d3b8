"""A small, fast and forgiving HTML tree for wrapper induction."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import xxhash

#: A quote opens a quoted value only after an equals sign; elsewhere it is a character like others.
_PART = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul caption".split())
#: An opening tag ends open elements of these kinds, up to a limit kind.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "thead": ()}
_LIMIT = frozenset("ul ol dl table body article main section div nav select html menu".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())

#: Elements whose text is never shown as text of the page.
_BANNED_TAGS = frozenset("form script style noscript iframe template svg math button select textarea head title dialog".split())
#: Marks of what is not the article, by tag, role, and words in class or id. They are evidence, not a verdict: a marked
#: container that holds most of the varying text is the article all the same.
_MARKED_TAGS = frozenset("nav footer aside menu".split())
_MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_MARKED_WORDS = frozenset("nav navbar navigation menu footer sidebar side aside ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies notice notices alert consent gdpr newsletter subscribe subscription signup share sharing social comment comments respond reply replies discussion disqus breadcrumb breadcrumbs crumbs related recommended pagination pager login search popup modal overlay toolbar widget masthead topbar skip".split())
_HEAD_WORDS = frozenset("header masthead topbar".split())
_MAIN_WORDS = frozenset("article post entry story".split())
#: First words of class names that tell how a container is laid out, not what it holds.
_LAYOUT = frozenset("no has have with without not is hide".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())

#: Levels of a tree that are aligned; deeper nodes count with their ancestor at that level.
DEPTH = 100

#: Weight of marked and of declared containers' text in the search for the article, the share of a level's text that the
#: next container on the way to it must have, and the share of its text that another container beside it needs.
MARKED, DECLARED, MOST, BESIDE = 0.1, 3.0, 0.6, 0.5


@dataclass(slots=True)
class Node:
    tag: str
    label: str = ""
    text: str = ""
    children: list = field(default_factory=list)
    path: int = 0
    banned: bool = False
    marked: bool = False
    head: bool = False
    main: bool = False
    size: int = 1
    shape: int = 0
    plain: int = 0
    linked: int = 0


def parse(source: str) -> Node:
    """The tree of a page. Text nodes have tag "#". Comments and declarations are left out; raw elements keep no text.

    Tags that are not closed end with their parent; a p ends at the next block; stray closing tags are ignored.
    """
    root = Node("root")
    stack, at, n = [root], 0, len(source)
    while at < n:
        m = _PART.match(source, at)
        if not m:
            break
        at = m.end()
        if (text := m[4]) is not None:
            top = stack[-1].children
            if top and top[-1].tag == "#":
                top[-1].text += text
            else:
                top.append(Node("#", "#", text))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in _LIMIT and tag not in _LIMIT and tag not in _BLOCK:
                    break
            continue
        if tag in _BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag not in _INLINE:
                    break
        if tag in _ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _ENDS[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in _LIMIT and stack[i].tag != "div":
                    break
        attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        node = Node(tag, tag)
        node.marked, node.banned, node.main = tag in _MARKED_TAGS, tag in _BANNED_TAGS, tag in ("article", "main")
        if attributes:
            names = [[w.lower() for w in _WORDS.findall(x)] for k in ("class", "id") for x in attributes.get(k, "").split()]
            node.label = f"{tag}.{'.'.join(sorted({w for x in names for w in x if not w.isdigit()}))}"
            words = {w for x in names if x and x[0] not in _LAYOUT for w in x}
            role = attributes.get("role", "").lower()
            node.marked |= role in _MARKED_ROLES or bool(words & _MARKED_WORDS and tag not in ("html", "body", "main") and tag not in _INLINE)
            node.main |= role == "main" or bool(words & _MAIN_WORDS)
            node.head = bool(words & _HEAD_WORDS) and tag not in ("html", "body", "h1", "h2")
        node.head |= tag == "header"
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in _VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def tidy(text: str) -> str:
    """Character references decoded, white space as one space, trimmed."""
    return " ".join(entities.unescape(text).split())


def step(path: int, label: str) -> int:
    """The path of a node from its parent's and its label."""
    return xxhash.xxh64_intdigest(label, path)


def measured(root: Node) -> Node:
    """Sets path, size and shape of all nodes. shape: equal for subtrees with equal labels."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        for c in node.children:
            c.path = step(node.path, c.label)
            todo.append(c)
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.children)
        node.shape = hash((node.label, *(c.shape for c in node.children)))
    return root


def weighed(root: Node, words) -> dict[int, list[int]]:
    """For each path of an element [n, plain, linked]: nodes, words outside links, words in links. words(text node)."""
    order, todo = [], [(root, False)]
    while todo:
        node, link = todo.pop()
        order.append(node)
        if node.tag == "#":
            n = words(node)
            node.plain, node.linked = (0, n) if link else (n, 0)
        else:
            todo += [(c, link or node.tag == "a") for c in node.children if not c.banned]
    out: dict[int, list[int]] = {}
    for node in reversed(order):
        if node.tag != "#":
            node.plain, node.linked = sum(c.plain for c in node.children if not c.banned), sum(c.linked for c in node.children if not c.banned)
            known = out.setdefault(node.path, [0, 0, 0])
            known[0], known[1], known[2] = known[0] + 1, known[1] + node.plain, known[2] + node.linked
    return out


def aligned(a: Node, b: Node, weights: dict | None = None) -> list[tuple[Node, Node]]:
    """Pairs of text nodes that simple tree matching of a and b puts together."""
    weights = {} if weights is None else weights
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.tag == "#":
            out.append((x, y))
            continue
        todo += _matched(x.children, y.children, weights)[1]
    return out


def _weight(x: Node, y: Node, weights: dict) -> int:
    if x.label != y.label:
        return 0
    if x.shape == y.shape:
        return x.size
    key = (x.shape, y.shape)
    if key not in weights:
        weights[key] = 1 + _matched(x.children, y.children, weights)[0]
    return weights[key]


def _matched(xs: list, ys: list, weights: dict) -> tuple[int, list]:
    """Weight and pairs of the best ordered matching. Equal subtrees at both ends are matched first, which loses nothing."""
    i, m, n = 0, len(xs), len(ys)
    while i < m and i < n and xs[i].shape == ys[i].shape:
        i += 1
    while m > i and n > i and xs[m - 1].shape == ys[n - 1].shape:
        m, n = m - 1, n - 1
    pairs = list(zip(xs[:i], ys[:i])) + list(zip(xs[m:], ys[n:]))
    total = sum(x.size for x, _ in pairs)
    a, b = xs[i:m], ys[i:n]
    if a and b:
        table = [[0] * (len(b) + 1)]
        for x in a:
            above, row = table[-1], [0]
            for j, y in enumerate(b):
                w = _weight(x, y, weights)
                row.append(max(above[j + 1], row[j], above[j] + w if w else 0))
            table.append(row)
        total += table[-1][-1]
        p, q = len(a), len(b)
        while p and q:
            if table[p][q] == table[p - 1][q]:
                p -= 1
            elif table[p][q] == table[p][q - 1]:
                q -= 1
            else:
                p, q = p - 1, q - 1
                pairs.append((a[p], b[q]))
    return total, pairs


def _slot(node: Node, known: dict[int, list[int]]) -> tuple[float, float]:
    """Varying words outside and inside links that a node's slot has on average over the host's pages."""
    n, plain, linked = known[node.path]
    return plain / n, linked / n


def _share(node: Node, known: dict, marks: bool) -> float:
    if node.tag == "#":
        return node.plain
    if node.banned:
        return 0.0
    return _slot(node, known)[0] * ((MARKED if node.marked or node.head else DECLARED if node.main else 1.0) if marks else 1.0)


def way_to_article(root: Node, known: dict, marks: bool) -> list[Node]:
    """Containers from the root to the one that holds the article: each the only one of its slot, with most of its
    parent's varying text over the host's pages."""
    way = [root]
    while True:
        shares = [(_share(c, known, marks), c) for c in way[-1].children]
        total = sum(x for x, _ in shares)
        best, node = max(shares, key=lambda x: x[0], default=(0, None))
        if not best or node.tag == "#" or node.tag in _TEXT_TAGS or node.tag in _INLINE or best < MOST * total or sum(c.path == node.path for c in way[-1].children) > 1:
            return way
        way.append(node)


def article(root: Node, constant, known: dict[int, list[int]] | None, marks: bool = True) -> str:
    """Blocks of the main text, joined by blank lines.

    constant(node): whether a text belongs to the host's template. known: what slots hold over the host's pages (see
    weighed), or None where the page stands alone. The way to the article follows the varying text; beside it, containers
    are left out that are marked, mostly links, or short against it, and so are marked ones inside. A page alone is read
    by its declared articles if it has some. marks: whether tags, roles and class words count as evidence.
    """
    own = weighed(root, lambda x: 0 if constant(x) else len(x.text.split()))
    slots = own if known is None else own | {k: v for k, v in known.items() if k in own}
    way = way_to_article(root, slots, marks)
    on_way, end = {id(x) for x in way}, way[-1]
    declared = marks and known is None and _declares(root)
    inside_end = end.tag not in ("root", "html", "body")
    beside = [x for x in way[1:] if x.tag not in ("html", "body")] or [x for x in end.children if x.tag != "#" and not x.banned]
    goal = max((_slot(x, slots)[0] for x in beside), default=0.0)

    def stays(node: Node, parent: Node, in_main: bool) -> bool:
        """Whether an element that is not on the way is read."""
        if marks and (node.marked or (node.head and not in_main)) and node.tag not in _INLINE:
            return False
        if in_main or id(parent) not in on_way or (parent is end and inside_end) or (marks and node.main):
            return True
        plain, linked = _slot(node, slots)
        if linked > plain:
            return False
        if node.tag in _TEXT_TAGS or node.tag in _INLINE:
            return parent is end or node.tag == "h1" or plain >= BESIDE * goal
        return plain >= BESIDE * goal

    blocks, parts = [], []

    def flush():
        if parts and (t := tidy("".join(parts))):
            blocks.append(t)
        parts.clear()

    stack: list[tuple[Node, Node | None, bool, bool]] = [(root, None, False, False)]
    while stack:
        node, parent, in_main, closing = stack.pop()
        if closing:
            flush()
        elif node.tag == "#":
            if (in_main or not declared) and not constant(node):
                parts.append(node.text)
        elif node.tag == "br":
            parts.append(" ")
        elif node.banned or (parent is not None and id(node) not in on_way and not stays(node, parent, in_main)):
            flush() if node.tag in _BLOCK else None
        else:
            if node.tag in _BLOCK:
                flush()
                stack.append((node, parent, in_main, True))
            in_main |= node.main and marks
            stack += [(c, node, in_main, False) for c in reversed(node.children)]
    flush()
    return "\n\n".join(blocks)


def _declares(root: Node) -> bool:
    """Whether the page names an article outside marked containers."""
    todo = [root]
    while todo:
        x = todo.pop()
        if x.main and not x.marked:
            return True
        todo += [c for c in x.children if not c.banned and not c.marked]
    return False
