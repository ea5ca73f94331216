"""Operator 6: main text of pages through wrappers inferred per host.

A page is a stream of tokens: structural elements that open and close, and texts
between them. A wrapper is a union-free regular expression over such tokens, kept as
a tree of nodes that may be optional ``?`` or repeated ``+``, with text slots. The pages of a host
are aligned one after the other into its wrapper:

- neighbouring nodes, or groups of up to four nodes, that repeat become one repeated group;
- two lists of children are aligned by their longest common subsequence, and what only one of
  them has becomes optional;
- texts that differ become a slot; a text that every page has in a slot is a template text.

Every slot counts its pages, characters and linked characters and keeps the hashes of the texts that all its pages have. The finished
wrapper says which slots hold the article: those below ``article`` or ``main`` if the host has
them, else those below the element with the most unlinked text that differs from page to page, without their template texts; and never anything
below an element that is by name, class, id or role a menu, header, footer, sidebar, notice,
advert, form, script, style or comment. Extraction matches each page against the wrapper, element by element, and takes the texts that fall
into these slots. What a page has beside the expression is taken if it stands on the path of such a slot.

Names. A class, id or role marks an element as a whole token (``menu``), or as one joined from such words and general ones
(``site-footer``, ``comment-list``), but not with a word of state (``no-sidebar``, ``menu-closed``). Where
all ``article`` and ``main`` elements of a page stand in marked elements, those that hold one and over half of the page's text are not marked.

Scale. Aligning is associative but for the order of optional parts, so each task folds its pages into one wrapper per host and only
wrappers are shuffled, in two rounds (host and salt, then host): a host with a third of all pages
is one row per task. Its pages meet its wrapper, cut down to what leads to slots of the article, in a join with stored tables on both
sides, which AQE can split. Trees are walked with explicit stacks and written as flat lists, so any depth of nesting is fine; alignments are exact
for lists of any length, with bit-parallel rows of which every ``ROWS``-th is kept.

Edge cases. Null or empty html, and pages without article text, give an empty string. A null or
broken url is the host "". A page on which the host's slots find nothing is read by a wrapper of its own. Truncated pages
and unclosed elements end where the page ends; an unclosed ``option`` ends with its sibling or parent, an unclosed ``a`` with the next one or with
the block it stands in, and only the elements
whose content HTML reads as text (``RAW``) run on to their own end tag. Repeated rows each get a result. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import read, ship, stored

SALTS = 32
GROUP = 4  # longest repeated group
ROWS = 256  # of an alignment, between two that are kept
WRAPPERS = 64  # read at a time in a worker

# Elements by what they are in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title".split())  # text up to the end tag, or to the end of the page
FOREIGN = frozenset("svg math".split())  # <x/> is closed inside; HTML blocks end it
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
NOT_ARTICLE = frozenset(
    "nav footer aside form button fieldset dialog menu head template svg math object select datalist optgroup option canvas audio video".split()
) | RAW
# what a class, id or role says an element is; the second kind also as the first or last word of a joined name
NOT_ARTICLE_WORDS = frozenset(
    (
        "ad ads advert adverts banner promo promotion cookie cookies consent gdpr side header topbar notice alert popup modal overlay subscribe subscription signup login share sharing "
        "social related recommended recommendations reply replies respond widget toolbar skip complementary contentinfo hidden"
    ).split()
)
NOT_ARTICLE_STEMS = frozenset(
    (
        "advertisement sponsor sponsored sidebar menu nav navbar navigation navigator breadcrumb breadcrumbs masthead footer bottombar "
        "newsletter comment comments disqus pagination pager"
    ).split()
)
GENERAL_WORDS = frozenset(
    (
        "area bar block blocks body box button buttons col column container content group holder icons inner inline item items left link links list main outer page panel "
        "post posts primary right row secondary section site slot sticky text top bottom global unit wrap wrapper article articles stories story form mobile desktop message law info settings accept"
    ).split()
)
STATE_WORDS = frozenset("no not has with without is are closed open opened visible collapsed expanded active enabled disabled layout off on hide show js".split())
ARTICLE_WORDS = frozenset("article main".split())
ARTICLE_PARTS = frozenset("article post entry content story".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "p": {"p"}}
LISTS = frozenset("ul ol dl table menu".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|aria-hidden|style|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")


def _marks(token: str) -> bool:
    """Whether a class, id or role is the name of something beside the article."""
    if token in NOT_ARTICLE_WORDS or token in NOT_ARTICLE_STEMS:
        return True
    words = [w for w in _SPLIT.split(token) if w]
    if len(words) < 2 or STATE_WORDS.intersection(words):
        return len(words) == 1 and (words[0] in NOT_ARTICLE_WORDS or words[0] in NOT_ARTICLE_STEMS)
    if words[0] in NOT_ARTICLE_STEMS or words[-1] in NOT_ARTICLE_STEMS:
        return True
    named = NOT_ARTICLE_WORDS.intersection(words)
    return bool(named) and GENERAL_WORDS.union(named).issuperset(words)


def _label(name: str, attributes: str) -> str:
    """Element name with its first class; a ! at the end if it cannot hold article text."""
    out, bad, tokens = name, name in NOT_ARTICLE, set()
    if attributes and not attributes.isspace():
        for key, *values in _ATTRIBUTE.findall(attributes):
            value, key = "".join(values).lower(), key.lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                bad = True
            elif key in ("class", "id", "role"):
                tokens.update(own := value.split())
                if key == "class" and own:
                    out += "." + _DIGITS.sub("", own[0]).replace("/", "_").replace("!", "_")
    if tokens and name not in ("article", "main", "body", "html"):
        words = {w for t in tokens for w in _SPLIT.split(t)}
        # the header of an article or post is its own
        bad = bad or any(_marks(t) for t in tokens if not (words & ARTICLE_PARTS and "header" in t))
        if "main" in words and not STATE_WORDS & words:
            out += ".main"
    return out + "!" * bad


def _tokens(page: str) -> Iterator[tuple[str | None, bool | str, int]]:
    """The token stream: (label, True, 0) opens, (None, False, 0) closes, (None, text, linked) is a text."""
    stack: list[str] = []  # names of open structural elements
    count: dict[str, int] = {}  # how often each is open
    foreign = 0
    text: list[str] = []
    linked, link = 0, -1  # link: the depth at which a link was opened

    def flush() -> Iterator[tuple]:
        nonlocal linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if whole:
                yield None, whole, min(linked, len(whole))
        linked = 0

    def pop() -> str:
        nonlocal link, foreign
        name = stack.pop()
        count[name] -= 1
        foreign -= name in FOREIGN
        if link > len(stack):
            link = -1
        return name

    skip, pos, end = None, 0, len(page)
    while pos < end:
        if skip:  # inside raw text everything up to its end tag is dropped
            m = re.compile(rf"</{skip}\s*>", re.I).search(page, pos)
            pos, skip = (m.end() if m else end), None
            continue
        m = _TOKEN.match(page, pos)
        pos = m.end()
        name = m[2]
        if name is None:
            got = m[0]
            if got[:2] not in ("<!", "<?"):
                text.append(got)
                if link >= 0:
                    linked += len(got)
            continue
        name = name.lower()
        if m[1]:
            if name in INLINE:
                if name == "a":
                    link = -1
                if not count.get(name):
                    continue
            if count.get(name):
                yield from flush()
                while pop() != name:
                    yield None, False, 0
                yield None, False, 0
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in RAW:
            yield from flush()
            if not m[3].endswith("/"):
                skip = name
            continue
        if (foreign or name in FOREIGN) and m[3].endswith("/"):
            yield from flush()
            continue
        if foreign and name in CLOSES_P and not count.get("foreignobject"):
            yield from flush()
            while foreign:
                pop()
                yield None, False, 0
        label = _label(name, m[3])
        if name in INLINE and not label.endswith("!"):
            if name == "a":
                link = len(stack)
            continue
        yield from flush()
        if name in VOID:
            continue
        if name in CLOSES_P and count.get("p"):
            above = next(x for x in reversed(stack) if x == "p" or x in LISTS)
            if above == "p":
                while pop() != "p":
                    yield None, False, 0
                yield None, False, 0
        while stack and name in CLOSES_SAME and stack[-1] in CLOSES_SAME[name]:
            pop()
            yield None, False, 0
        stack.append(name)
        count[name] = count.get(name, 0) + 1
        foreign += name in FOREIGN
        yield label, True, 0
    yield from flush()


def blocks(page: str) -> list[tuple[str | None, bool | str, int]]:
    """The token stream as a list, in which no marked element holds the article of the page."""
    tokens = list(_tokens(page))
    marked = outside = 0
    holds: list[list[int]] = []  # per open element: place, characters before it, whether an article is inside
    total, lifted, inside = 0, [], False
    for i, (label, what, _) in enumerate(tokens):
        if what is True:
            holds.append([i, total, 0])
            marked += label[-1] == "!"
            if label.split(".", 1)[0] in ARTICLE_WORDS:
                inside = True
                outside += not marked
                holds[-1][2] = 1
        elif what is False:
            place, before, article = holds.pop()
            if tokens[place][0][-1] == "!":
                marked -= 1
                if article:
                    lifted.append((place, total - before))
            if article and holds:
                holds[-1][2] = 1
        else:
            total += len(what)
    if not inside or outside:
        return tokens
    while holds:  # elements that the page leaves open
        place, before, article = holds.pop()
        if article and tokens[place][0][-1] == "!":
            lifted.append((place, total - before))
        if article and holds:
            holds[-1][2] = 1
    for place, size in lifted:
        if 2 * size > total:
            tokens[place] = (tokens[place][0].rstrip("!"), True, 0)
    return tokens


# ---- wrappers --------------------------------------------------------------


class Node:
    """A node of a wrapper: an element, a text slot ``#``, or a group ``()``.

    same: for a slot, the hashes and lengths of the texts that all its pages have. kids: a list, or (cross, a, b) for
    two lists that are still to be aligned; cross if they are of different pages.
    """

    __slots__ = ("label", "optional", "repeated", "pages", "chars", "linked", "same", "kids")

    def __init__(self, label, optional=False, repeated=False, pages=1, chars=0, linked=0, same=None, kids=None):
        self.label, self.optional, self.repeated, self.pages, self.chars, self.linked = label, optional, repeated, pages, chars, linked
        self.same, self.kids = same, [] if kids is None else kids

    def as_optional(self) -> Node:
        return Node(self.label, True, self.repeated, self.pages, self.chars, self.linked, self.same, self.kids)


def _joined(a: Node, b: Node, cross: bool) -> Node:
    """Two nodes with one label as one; what is below them is aligned later."""
    same = kids = None
    if a.label == "#":
        same = {h: n for h, n in a.same.items() if h in b.same} if cross else {**a.same, **b.same}
    elif a.label == "()":
        kids = [_joined(x, y, cross) for x, y in zip(a.kids, b.kids, strict=True)]
    else:
        kids = (cross, a.kids, b.kids)
    pages = a.pages + b.pages if cross else max(a.pages, b.pages)
    return Node(a.label, a.optional or b.optional, a.repeated or b.repeated, pages, a.chars + b.chars, a.linked + b.linked, same, kids)


def _labels(nodes: list[Node]) -> list[str]:
    """A group has the labels of its nodes; groups in groups at least double in length, so they are never deep."""
    return [n.label if n.label != "()" else "(" + " ".join(_labels(n.kids)) + ")" for n in nodes]


def _resolved(kids: list | tuple) -> list[Node]:
    waiting = []
    while type(kids) is tuple:
        waiting.append((kids[0], kids[2]))
        kids = kids[1]
    for cross, more in reversed(waiting):
        kids = align(kids, _resolved(more), cross)
    return kids


def settle(root: Node) -> Node:
    """Align what is still to be aligned, from the top down."""
    stack = [root]
    while stack:
        node = stack.pop()
        if type(node.kids) is tuple:
            node.kids = _resolved(node.kids)
        stack += node.kids
    return root


def merge(a: Node, b: Node) -> Node:
    """The wrappers of different pages as one."""
    return settle(_joined(a, b, True))


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence.

    A row of the table is a bit per element of ``a``, 0 where the length grows; every ROWS-th row is kept and the others are made
    again while the path is followed back.
    """
    begin, end = 0, 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[begin : len(a) - end], b[begin : len(b) - end]
    whole = (1 << len(x)) - 1
    places: dict[str, int] = {}
    for i, label in enumerate(x):
        places[label] = places.get(label, 0) | 1 << i

    def step(row: int, label: str) -> int:
        hit = row & places.get(label, 0)
        return ((row + hit) | (row - hit)) & whole

    kept, row = [whole], whole
    for j, label in enumerate(y, 1):
        row = step(row, label)
        if j % ROWS == 0:
            kept.append(row)
    middle, i, j = [], len(x), len(y)
    rows: list[int] = []  # the rows from the kept one below j up to j
    while i and j:
        if not rows or len(rows) - 1 < (j - 1) % ROWS + 1:
            base = (j - 1) // ROWS
            rows = [kept[base]]
            for label in y[base * ROWS : j]:
                rows.append(step(rows[-1], label))
        at = (j - 1) % ROWS + 1
        bit = 1 << (i - 1)
        if rows[at] & bit:
            i -= 1
        elif at and not rows[at - 1] & bit:
            j -= 1
            rows.pop()
        else:
            i, j = i - 1, j - 1
            rows.pop()
            middle.append((begin + i, begin + j))
        if len(rows) == 1:
            rows = []
    head = [(i, i) for i in range(begin)]
    return head + middle[::-1] + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def align(a: list[Node], b: list[Node], cross: bool) -> list[Node]:
    """Two lists of children: common ones joined in order, the others optional."""
    la, lb = _labels(a), _labels(b)
    if la == lb:
        return [_joined(x, y, cross) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for x, y in [*common(la, lb), (len(a), len(b))]:
        out += [n.as_optional() for n in a[i:x]] + [n.as_optional() for n in b[j:y]]
        if x < len(a):
            out.append(_joined(a[x], b[y], cross))
        i, j = x + 1, y + 1
    return fold(out)


def fold(nodes: list[Node]) -> list[Node]:
    """Neighbours that repeat, alone or in groups, as one repeated node."""
    out: list[Node] = []
    for n in nodes:
        if out and out[-1].label == n.label and n.label != "()":
            out[-1] = _joined(out[-1], n, False)
            out[-1].repeated = True
        else:
            out.append(n)
        for size in range(2, GROUP + 1):
            if len(out) > size and out[-size - 1].label == "()" and _labels(out[-size - 1].kids) == _labels(out[-size:]):
                group = out[-size - 1]
                out[-size - 1] = Node("()", group.optional, True, group.pages, kids=[_joined(x, y, False) for x, y in zip(group.kids, out[-size:], strict=True)])
                del out[-size:]
                break
            if len(out) >= 2 * size and _labels(out[-2 * size : -size]) == _labels(out[-size:]):
                out[-2 * size :] = [Node("()", False, True, kids=[_joined(x, y, False) for x, y in zip(out[-2 * size : -size], out[-size:], strict=True)])]
                break
    return out


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=6).digest(), "big")


def page_wrapper(page: str) -> Node:
    """The wrapper of one page."""
    root = Node("")
    stack = [root]
    for label, what, linked in blocks(page):
        if what is True:
            node = Node(label)
            stack[-1].kids.append(node)
            stack.append(node)
        elif what is False:
            done = stack.pop()
            done.kids = fold(done.kids)
        else:
            stack[-1].kids.append(Node("#", chars=len(what), linked=linked, same={text_hash(what): len(what)}))
    for node in stack[::-1]:
        node.kids = fold(node.kids)
    return settle(root)


def _differing(slot: Node) -> int:
    """Characters of a slot that are not template text."""
    return slot.chars if slot.pages == 1 else max(0, slot.chars - slot.pages * sum(slot.same.values()))


def expression(root: Node) -> str:
    """The wrapper as text: <x>...</x>, # for slots, = for template texts, ( )+ and ( )?."""
    out: list[str] = []
    stack: list[Node | str] = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        mark = "+" * node.repeated + "?" * node.optional
        parts: list[Node | str] = ["("] if mark else []
        if node.label == "#":
            parts.append("=" if node.pages > 1 and not _differing(node) else "#")
        elif node.label in ("", "()"):
            parts += node.kids
        else:
            parts += [f"<{node.label}>", *node.kids, f"</{node.label.split('.')[0].rstrip('!')}>"]
        stack += reversed([*parts, ")" + mark] if mark else parts)
    return "".join(out)


def packed(root: Node) -> str:
    """A wrapper as JSON: a flat list of nodes, parents first."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        same = None if n.same is None else [x for item in n.same.items() for x in item]
        out.append([n.label, n.optional + 2 * n.repeated, n.pages, n.chars, n.linked, same, len(n.kids)])
        stack += reversed(n.kids)
    return json.dumps(out, separators=(",", ":"))


def unpacked(text: str) -> Node:
    root, waiting = None, []  # waiting: nodes with the number of kids still to come
    for label, flags, pages, chars, linked, same, kids in json.loads(text):
        pairs = None if same is None else dict(zip(same[::2], same[1::2], strict=True))
        node = Node(label, bool(flags & 1), bool(flags & 2), pages, chars, linked, pairs)
        if waiting:
            waiting[-1][0].kids.append(node)
            waiting[-1][1] -= 1
            while waiting and not waiting[-1][1]:
                waiting.pop()
        else:
            root = node
        if kids:
            waiting.append([node, kids])
    return root


class Place:
    """An element of a wrapper, groups left out: its slots together, its parent, and what names say about it."""

    __slots__ = ("parent", "label", "depth", "slots", "mass", "marked", "article", "header", "first")

    def __init__(self, parent: Place | None, label: str, first: int):
        name = label.split(".", 1)[0].rstrip("!")
        self.parent, self.label, self.first = parent, label, first
        self.depth = parent.depth + 1 if parent else 0
        self.slots: list[Node] = []
        self.mass = 0.0
        self.marked = label.endswith("!") or bool(parent and parent.marked)
        own = not ARTICLE_WORDS.isdisjoint(label.rstrip("!").split("."))
        self.article = own or bool(parent and parent.article)
        # below a header that is not the article's own
        self.header = bool(parent and parent.header) or (name == "header" and not (parent and parent.article))


def places(wrapper: Node) -> list[Place]:
    """The elements with the same path as one place, parents first."""
    root = Place(None, "", 0)
    out, known = [root], {}
    stack = [(wrapper, root)]
    while stack:
        node, place = stack.pop()
        todo = list(reversed(node.kids))
        while todo:
            n = todo.pop()
            if n.label == "#":
                place.slots.append(n)
            elif n.label == "()":
                todo += reversed(n.kids)
            else:
                key = (id(place), n.label)
                if key not in known:
                    known[key] = Place(place, n.label, len(out))
                    out.append(known[key])
                stack.append((n, known[key]))
    return out


def content_places(wrapper: Node) -> tuple[list[Place], bool]:
    """The places whose slots are the article, and whether their template texts are left out."""
    every = places(wrapper)
    allowed = [p for p in every if p.slots and not p.marked]
    named = [p for p in allowed if p.article]
    if named:
        return [p for p in named if not p.header], False
    # no element says so: the one under which most unlinked, differing text stands, as deep as nearly all of it goes
    own: dict[int, float] = {}
    flat = lambda p: 2 * sum(s.linked for s in p.slots) <= sum(s.chars for s in p.slots)
    for p in allowed:
        if flat(p):
            own[id(p)] = sum(_differing(s) for s in p.slots) + 1e-3 * sum(s.chars for s in p.slots)
            p.mass += own[id(p)]
    for p in sorted(every, key=lambda p: -p.depth):
        if p.parent:
            p.parent.mass += p.mass
    if not every[0].mass:
        return [], False
    below: dict[int, list[Place]] = {}
    for p in every[1:]:
        below.setdefault(id(p.parent), []).append(p)
    here = every[0]
    while True:
        deeper = [p for p in below.get(id(here), []) if p.mass and p.mass >= 0.7 * here.mass]
        if not deeper or own.get(id(here), 0.0) > 0.3 * here.mass:
            break
        here = max(deeper, key=lambda p: p.mass)
    if here.slots and here.parent:  # a text element itself; its neighbours belong to the article as well
        here = here.parent
    under = {id(here)}
    for p in every:
        if p.parent and id(p.parent) in under:
            under.add(id(p))
    keep = [p for p in allowed if id(p) in under and flat(p) and not p.header]
    # pages that are all alike tell nothing about templates
    return keep, any(s.pages > 1 and _differing(s) for p in keep for s in p.slots)


def content_paths(wrapper: Node) -> list[str]:
    """The paths of the elements whose texts are the article, to look at."""
    out = []
    for p in content_places(wrapper)[0]:
        names = []
        while p.parent:
            names.append(p.label)
            p = p.parent
        out.append("".join(f"/{x}" for x in reversed(names)))
    return out


# ---- reading pages by a wrapper -------------------------------------------------


class Items:
    """The children of a wrapper's element as a sequence with loops, for matching lists of children against it."""

    __slots__ = ("nodes", "loops", "by_label")

    def __init__(self, kids: list):
        self.nodes: list = []
        self.loops: list[tuple] = []  # per item the loops around it, the inner ones first: (first item, last item)
        spans = []
        stack = [(k, ()) for k in reversed(kids)]
        while stack:
            k, around = stack.pop()
            if isinstance(k, int):  # a group ends
                spans[k][1] = len(self.nodes) - 1
            elif k[0] == "()":
                spans.append([len(self.nodes), 0])
                stack.append((len(spans) - 1, ()))
                stack += [(x, (len(spans) - 1, *around) if k[1] & 2 else around) for x in reversed(k[3])]
            else:
                self.nodes.append(k)
                self.loops.append(around)
        alone = [((i, i),) if k[1] & 2 else () for i, k in enumerate(self.nodes)]
        self.loops = [own + tuple(tuple(spans[x]) for x in around) for own, around in zip(alone, self.loops, strict=True)]
        self.by_label: dict[str, list[int]] = {}
        for i, k in enumerate(self.nodes):
            self.by_label.setdefault(k[0], []).append(i)

    def match(self, labels: list[str]) -> list:
        """Per label the node it falls on, or None: the next in the innermost loop, else from its start, else further on."""
        at, out = -1, []
        for label in labels:
            found = None
            options = self.by_label.get(label, ())
            if options:
                for first, last in self.loops[at] if at >= 0 else ():
                    inside = [k for k in options if first <= k <= last]
                    if inside:
                        found = next((k for k in inside if k > at), inside[0])
                        break
                else:
                    found = next((k for k in options if k > at), None)
            if found is not None:
                at = found
            out.append(None if found is None else self.nodes[found])
        return out


class Reader:
    """Reads pages by a wrapper, cut down to what leads to the slots of the article.

    A node is [label, flags, templates or None, kids, items]; templates are the hashes a slot of the article leaves out.
    """

    def __init__(self, text: str):
        found = json.loads(text)
        root, waiting = None, []
        for label, flags, templates, kids in found["nodes"]:
            node = [label, flags, templates if templates is None else frozenset(templates), [], None]
            if waiting:
                waiting[-1][0][3].append(node)
                waiting[-1][1] -= 1
                while waiting and not waiting[-1][1]:
                    waiting.pop()
            else:
                root = node
            if kids:
                waiting.append([node, kids])
        self.root = root
        self.paths = {(parent, label): i + 1 for i, (parent, label) in enumerate(found["paths"])}
        self.content = frozenset(found["content"])

    def text(self, page: str) -> str:
        """The texts in the slots of the article, in page order."""
        root: list = ["", []]
        stack, texts = [root], []
        for label, what, _ in blocks(page):
            if what is True:
                node = [label, []]
                stack[-1][1].append(node)
                stack.append(node)
            elif what is False:
                stack.pop()
            else:
                stack[-1][1].append(("#", len(texts)))
                texts.append(what)
        taken = [False] * len(texts)
        todo: list = [(root, self.root, 0)]  # element of the page, of the wrapper, number of its path
        while todo:
            (_, kids), mine, path = todo.pop()
            if mine is not None and mine[4] is None:
                mine[4] = Items(mine[3])
            met = mine[4].match([k[0] for k in kids]) if mine is not None else [None] * len(kids)
            for kid, slot in zip(kids, met, strict=True):
                if kid[0] != "#":
                    at = self.paths.get((path, kid[0]), -1)
                    if at >= 0 or slot is not None:
                        todo.append((kid, slot, at))
                elif slot is not None:
                    taken[kid[1]] = slot[2] is not None and (not slot[2] or text_hash(texts[kid[1]]) not in slot[2])
                else:
                    taken[kid[1]] = path in self.content
        return "\n\n".join(t for t, yes in zip(texts, taken, strict=True) if yes)


def reader_text(wrapper: Node) -> str:
    """What a Reader needs of a wrapper, as JSON."""
    keep, templates = content_places(wrapper)
    slots = {id(s) for p in keep for s in p.slots}
    # elements and groups above the slots of the article keep their kids, others stand as they are
    order, above, stack = [], {}, [(wrapper, None)]
    while stack:
        node, parent = stack.pop()
        above[id(node)] = parent
        order.append(node)
        stack += [(k, node) for k in reversed(node.kids)]
    leads = set()
    for node in order:
        if id(node) in slots:
            up = node
            while up is not None and id(up) not in leads:
                leads.add(id(up))
                up = above[id(up)]
    nodes, stack = [], [wrapper]
    while stack:
        n = stack.pop()
        kids = n.kids if id(n) in leads or n.label == "()" else []
        out = sorted(n.same) if templates and n.pages > 1 and id(n) in slots else []
        nodes.append([n.label, n.optional + 2 * n.repeated, out if id(n) in slots else None, len(kids)])
        stack += reversed(kids)
    number, paths, content = {}, [], []
    chosen = {id(p) for p in keep}
    for p in places_above(keep):
        if p.parent is None:
            number[id(p)] = 0
        else:
            paths.append([number[id(p.parent)], p.label])
            number[id(p)] = len(paths)
        if id(p) in chosen:
            content.append(number[id(p)])
    return json.dumps({"nodes": nodes, "paths": paths, "content": content}, separators=(",", ":"))


def places_above(keep: list[Place]) -> list[Place]:
    """The places and all above them, parents first."""
    found: dict[int, Place] = {}
    for p in keep:
        while p is not None and id(p) not in found:
            found[id(p)] = p
            p = p.parent
    return sorted(found.values(), key=lambda p: p.depth)


_readers: dict[str, Reader] = {}


def reader(text: str) -> Reader:
    """The reader of a wrapper, kept for the pages that follow."""
    if text not in _readers:
        if len(_readers) >= WRAPPERS:
            _readers.clear()
        _readers[text] = Reader(text)
    return _readers[text]


def main_text(page: str, by: str | None) -> str:
    """The main text by a host's wrapper, or by one of the page alone where that finds nothing."""
    text = reader(by).text(page) if by else ""
    return text or Reader(reader_text(page_wrapper(page))).text(page)


# ---- Spark jobs ----------------------------------------------------------


def _emit(folded: dict) -> pa.RecordBatch:
    salt = TaskContext.get().partitionId() % SALTS
    return pa.RecordBatch.from_pydict(
        {"host": pa.array(list(folded), pa.string()), "salt": pa.array([salt] * len(folded), pa.int32()), "wrapper": pa.array([packed(w) for w in folded.values()], pa.string())}
    )


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    folded: dict[str, Node] = {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            new = page_wrapper(page or "")
            folded[host] = merge(folded[host], new) if host in folded else new
    if folded:
        yield _emit(folded)


def _fold_wrappers(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host from rows sorted by host."""
    host, own = None, None
    for batch in groups:
        for h, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
            new = unpacked(text)
            if h == host:
                own = merge(own, new)
                continue
            if own is not None:
                yield _emit({host: own})
            host, own = h, new
    if own is not None:
        yield _emit({host: own})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) of all pages (host, html)."""
    ship(pages.sparkSession)
    schema = "host string, salt int, wrapper string"
    out = pages.mapInArrow(_fold_pages, schema)
    for keys in (("host", "salt"), ("host",)):
        out = out.repartition(*keys).sortWithinPartitions("host", "salt", "wrapper").mapInArrow(_fold_wrappers, schema)
    return out.select("host", "wrapper")


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = [unpacked(w) for w in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "host": batch.column("host"),
                "expression": pa.array([expression(w) for w in wrappers], pa.string()),
                "reader": pa.array([reader_text(w) for w in wrappers], pa.string()),
            }
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, by) if page else "" for page, by in zip(batch.column("html").to_pylist(), batch.column("reader").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict(
            {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())}
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page (page_id, url, html)."""
    ship(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.trim("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host")
    )
    wrappers = infer_wrappers(own.select("host", "html")).mapInArrow(_finished, "host string, expression string, reader string")
    readers = stored(wrappers, "page-wrappers").select("host", "reader")
    return own.join(readers, "host", "left").select("page_id", "url", "html", "reader").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(read(spark, sf_dir, "pages"))
