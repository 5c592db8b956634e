"""Wrapper induction: page trees, their alignment, and what varies between pages of one host.

A page is a tree of slots: the blocks of one kind (element and marks) below the
same slot are one slot, which holds their texts.  Slots of two pages are aligned
by simple tree matching.  As a slot's children differ in kind, each can match one
child of the other side at most, and the best order-keeping match is a heaviest
increasing subsequence, found in n log n steps.  A text that the pages of a host
have in the same slot nearly always is template; all others are content.
"""

from __future__ import annotations

import html
import json
import re
import sys
from bisect import bisect_right
from collections import Counter
from contextlib import contextmanager
from functools import lru_cache
from heapq import heapify, heappop, heappush

import xxhash

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# No pattern can fail after it has read far: what is left open ends with the page, a last quote at the next `>`.
RAW = re.compile(r"<(script|style|noscript|template|iframe|svg|textarea|title)\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)", re.S | re.I)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"(?:[^\"]*+\"|[^>]*+)|'(?:[^']*+'|[^>]*+))*+)(?:>|\Z)|([^<]+|<)")
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)

BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "head", "body", "legend"}
#: Elements, and words in class, id or role, that mark what is not the article.
NOISE_TAGS = set("nav header footer aside form head button select input dialog menu script style noscript template iframe svg textarea title".split())
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar aside complementary footer contentinfo header masthead topbar cookie cookies consent notice notices notification alert popup modal overlay "
    "comment comments reply replies discussion disqus share sharing social related recommended recommendations newsletter subscribe signup login "
    "search pagination pager widget toolbar skip copyright legal form".split()
)
#: Words that say nothing of their own beside one of those, as in site-footer.
NEUTRAL_WORDS = set(
    "area bar block body bottom box btn button close col collapse column container content desktop div dropdown first fixed global group header home icon id inner item items js last left link links "
    "list main mobile outer page panel post primary right row secondary section site slot small sticky the title top ul unit user web wrap wrapper".split()
)
MAIN_TAGS = {"article", "main"}
HEADINGS = {f"h{i}" for i in range(1, 7)}
BARRIERS = {"article", "main", "td", "table"}  # a stray inline end tag closes nothing outside
ENDS_SAME = {"li", "dt", "dd", "tr", "td", "th", "option"}
#: Elements whose text is content wherever nothing speaks against it.
TEXT_TAGS = set("h1 h2 h3 h4 h5 h6 p pre blockquote li dd dt td th caption figcaption".split())
CONSTANT, LEAST_PAGES = 0.8, 3  # a constant text is on that share of the pages with its slot, and on so many pages
ALIKE = 0.5  # pages whose varying parts have that share of three-word runs in common are copies


class Node:
    __slots__ = ("tag", "marks", "children", "noise", "key")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.children = tag, marks, []
        self.noise = tag in NOISE_TAGS or (tag not in ("html", "body", "article", "main") and any(map(speaks_of_noise, marks.lower().split())))
        self.key = f"{tag}.{marks}"


def speaks_of_noise(name: str) -> bool:
    """Whether a class, id or role as a whole names noise: share-buttons and site-footer do, share-price doesn't."""
    words = {re.sub(r"\d+$", "", w) for w in re.split(r"[^a-z0-9]+", name)} - {""}
    noisy = {w for w in words if w in NOISE_WORDS or w.removesuffix("s") in NOISE_WORDS}
    return bool(noisy) and all(w in NEUTRAL_WORDS or w.removesuffix("s") in NEUTRAL_WORDS for w in words - noisy)


@contextmanager
def deep_trees():
    """Walks over a tree go as deep as the page's elements are nested, which has no bound."""
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 10_000_000))
    try:
        yield
    finally:
        sys.setrecursionlimit(limit)


def parse(page: str) -> Node:
    """The element tree; strings among the children are text as written. Missing end tags are supplied."""
    page = COMMENT.sub("", RAW.sub("", page))
    root = Node("html")
    stack = [root]
    # Places in the stack: of each tag, of what stops or takes an implied end, of barriers. Each is pushed and popped once.
    places: dict[str, list[int]] = {}
    stops: list[int] = []
    barriers: list[int] = []

    def close(i: int) -> None:
        for n in stack[i:]:
            places[n.tag].pop()
        del stack[i:]
        for own in (stops, barriers):
            while own and own[-1] >= i:
                own.pop()

    for m in TOKEN.finditer(page):
        end, tag, attributes, text = m.groups()
        if text is not None:
            stack[-1].children.append(text)
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if end:
            own = places.get(tag)
            if own and (tag in BLOCKS or not barriers or barriers[-1] <= own[-1]):
                close(own[-1])
            continue
        if tag in VOID:
            stack[-1].children.append(" " if tag in ("br", "wbr", "hr") else "")
            if tag == "hr":
                stack[-1].children.append(Node("hr"))
            continue
        closes_p = tag in CLOSES_P
        if closes_p or tag in ENDS_SAME:  # implied ends: an open p before a block, an open li before a li, ...
            for i in reversed(stops):
                t = stack[i].tag
                if (t == "p" and closes_p) or (t == tag and tag in ENDS_SAME) or (t in ("dt", "dd") and tag in ("dt", "dd")):
                    close(i)
                    break
                if t in BLOCKS:
                    break
        marks = " ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(attributes)) if attributes and "=" in attributes else ""
        node = Node(tag, marks)
        stack[-1].children.append(node)
        if not attributes.rstrip().endswith("/") or tag in BLOCKS:
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS or tag in ENDS_SAME:
                stops.append(len(stack))
            if tag in BARRIERS:
                barriers.append(len(stack))
            stack.append(node)
    return root


class Slot:
    """Blocks of one kind below the same slot."""

    __slots__ = ("key", "children", "texts", "n", "place")

    def __init__(self, key: str):
        self.key, self.children, self.texts, self.n, self.place = key, {}, Counter(), 1, None

    def child(self, key: str) -> Slot:
        found = self.children.get(key)
        if found is None:
            found = self.children[key] = Slot(key)
        return found


def name(text: str) -> int:
    """64 bits, signed; texts are only told apart within one slot, slots within one host."""
    return xxhash.xxh3_64_intdigest(text) - 2**63


def blocks(root: Node) -> tuple[Slot, list[tuple[Node, Slot, str]]]:
    """The slot tree of a page and its blocks (element, slot, text) in page order, without noise."""
    top = Slot(root.key)
    out: list[tuple[Node, Slot, str]] = []
    run: list[str] = []

    def close(node: Node, slot: Slot) -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                out.append((node, slot, text))
                slot.texts[name(text)] = 1
            run.clear()

    def walk(n: Node, node: Node, slot: Slot) -> None:
        for c in n.children:
            if isinstance(c, str):
                run.append(c)
            elif c.noise:
                continue
            elif c.tag in BLOCKS:
                close(node, slot)
                own = slot.child(c.key)
                walk(c, c, own)
                close(c, own)
            else:
                walk(c, node, slot)

    walk(root, root, top)
    close(root, top)
    return top, out


def match(a: Slot, b: Slot, pairs: list) -> int:
    """Simple tree matching: the most slots that map with their order and ancestry kept; adds the pairs that do."""
    if a.key != b.key:
        return 0
    place = {k: i for i, k in enumerate(a.children)} if a.place is None else a.place
    # Heaviest increasing subsequence: `ends` and `sums` grow together; a heavier one that ends sooner ousts the rest.
    ends: list[int] = []
    sums: list[int] = []
    tails: list[tuple] = []
    for key, child in b.children.items():
        i = place.get(key)
        if i is None:
            continue
        own: list = []
        w = match(a.children[key], child, own)
        at = bisect_right(ends, i)
        total, chain = (sums[at - 1] + w, tails[at - 1]) if at else (w, None)
        stop = at
        while stop < len(ends) and sums[stop] <= total:
            stop += 1
        ends[at:stop], sums[at:stop], tails[at:stop] = [i], [total], [(own, chain)]
    chain = tails[-1] if tails else None
    while chain:
        pairs.extend(chain[0])
        chain = chain[1]
    pairs.append((a, b))
    return 1 + (sums[-1] if sums else 0)


def _runs(texts: list[str]) -> set[tuple]:
    words = " ".join(texts).split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


def copies(a: list[str], b: list[str]) -> bool:
    """Whether two pages say the same: what they don't share is alike itself, or they share all."""
    both = set(a) & set(b)
    a, b = [t for t in a if t not in both], [t for t in b if t not in both]
    if not a or not b:
        return not a and not b
    a, b = _runs(a), _runs(b)
    return len(a & b) >= ALIKE * min(len(a), len(b))


def _merged(old: dict, new: dict) -> dict:
    """Children of both sides: those that only the new side has follow the one that they follow there."""
    after: dict[str | None, list[str]] = {}
    last = None
    for key in new:
        if key in old:
            last = key
        else:
            after.setdefault(last, []).append(key)
    out = {k: new[k] for k in after.get(None, ())}
    for key, child in old.items():
        out[key] = child
        out |= {k: new[k] for k in after.get(key, ())}
    return out


def _join(wrapper: Slot, page: Slot) -> None:
    """Align a page with the wrapper: slots that match are counted, new ones are added."""
    pairs: list = []
    match(wrapper, page, pairs)
    for w, p in pairs:
        w.n += 1
        w.texts.update(p.texts)
        if not p.children.keys() <= w.children.keys():
            w.children = _merged(w.children, p.children)


def _constant(wrapper: Slot) -> list[list]:
    """[parent's place, key, constant texts] of the slots that hold constant texts or are above some, parents first."""
    every, todo = [], [(-1, wrapper)]
    while todo:
        above, slot = todo.pop()
        every.append((above, slot.key, sorted(t for t, n in slot.texts.items() if n >= LEAST_PAGES and n >= CONSTANT * slot.n)))
        todo += [(len(every) - 1, c) for c in reversed(slot.children.values())]
    return _with_texts(every)


def _needed(above: list[int], own: list[bool]) -> list[bool]:
    """Which slots (parents first) are wanted themselves or are above some."""
    out = list(own)
    for i in range(len(out) - 1, 0, -1):
        out[above[i]] |= out[i]
    return out


def _with_texts(every: list[tuple]) -> list[list]:
    needed = _needed([above for above, _, _ in every], [bool(texts) for *_, texts in every])
    place = {}
    for i, need in enumerate(needed):
        if need:
            place[i] = len(place)
    return [[place.get(above, -1), key, texts] for i, (above, key, texts) in enumerate(every) if needed[i]]


@lru_cache(maxsize=64)
def _page_texts(page: str) -> list[str]:
    return [t for _, _, t in blocks(parse(page))[1]]


@deep_trees()
def different(pages: list[str], most: int | None = None) -> list[str]:
    """The pages, `most` at most, in order of their html, that are no copies of one before."""
    out: list[str] = []
    for page in sorted(set(p for p in pages if p)):
        if not is_copy(page, out):
            out.append(page)
            if len(out) == most:
                break
    return out


@deep_trees()
def is_copy(page: str, others: list[str]) -> bool:
    return any(copies(_page_texts(page), _page_texts(o)) for o in others)


@deep_trees()
def induce(pages: list[str]) -> str:
    """The wrapper of the pages of a host as JSON: how many pages it comes from (copies tell nothing and are left out) and the constant texts of its slots.

    For pages at hand; q10_extraction counts over all pages of a table.
    """
    wrapper, seen = None, different(pages)
    for page in seen:
        slots, _ = blocks(parse(page))
        if wrapper is None:
            wrapper = slots
        else:
            _join(wrapper, slots)
    return json.dumps({"n": len(seen), "w": _constant(wrapper) if wrapper else []})


def loaded(text: str | None) -> tuple[int, Slot | None]:
    """A wrapper from its JSON: number of pages, and slots with their constant texts."""
    d = json.loads(text) if text else {"n": 0, "w": []}
    slots: list[Slot] = []
    for above, key, texts in d["w"]:
        slots.append(slots[above].child(key) if slots else Slot(key))
        slots[-1].texts = frozenset(texts)
    for slot in slots:
        slot.place = {k: i for i, k in enumerate(slot.children)}
    return d["n"], slots[0] if slots else None


def path(above: int | None, key: str) -> int:
    """The name of a slot in all pages of its host."""
    return name(f"{above}/{key}")


@deep_trees()
def outline(page: str) -> tuple[int, list[int], list[str], list[int], list[int], list[int]]:
    """Name of a page (that of all that follows), its slots, parents first (place of the parent, key, path), and its texts (place of the slot, name)."""
    above, keys, paths, at, texts = [], [], [], [], []
    todo = [(-1, blocks(parse(page))[0])]
    while todo:
        up, slot = todo.pop()
        here = len(keys)
        above.append(up)
        keys.append(slot.key)
        paths.append(path(paths[up] if here else None, slot.key))
        at += [here] * len(slot.texts)
        texts += slot.texts
        todo += [(here, c) for c in reversed(slot.children.values())]
    return name(json.dumps([paths, at, texts])), above, keys, paths, at, texts


def steps(above: list[int], keys: list[str], paths: list[int], wanted: set[int]) -> list[tuple]:
    """(path, parent's path, key, path before it below the parent; 0 if none) of the slots of a page that are wanted or above such, and of the root."""
    needed = _needed(above, [i == 0 or p in wanted for i, p in enumerate(paths)])
    last: dict[int, int] = {}
    out = []
    for i, need in enumerate(needed):
        if need:
            up = above[i]
            out.append((paths[i], paths[up] if i else 0, keys[i], last.get(up, 0)))
            last[up] = paths[i]
    return out


def frame(rows: list[tuple], texts: dict[int, list[int]]) -> str:
    """The slots of all pages of a host as JSON (see loaded), from how often each step (path, parent's path, key, path before) was taken, with the texts given.

    Siblings stand as the pages have them; where pages contradict each other, the fewest steps are broken at each place.
    """
    below: dict[int, dict[int, str]] = {}
    after: dict[int, list[tuple[int, int]]] = {}
    before: Counter = Counter()
    for own, up, key, previous, n in rows:
        below.setdefault(up, {})[own] = key
        if previous:
            after.setdefault(previous, []).append((own, n))
            before[own] += n
    every: list[tuple] = []
    todo: list[tuple] = [(-1, own, key) for own, key in below[0].items()]
    while todo:
        above, own, key = todo.pop()
        here = len(every)
        every.append((above, key, sorted(texts.get(own, ()))))
        children = below.get(own, {})
        heap, done, order = [(before[c], c) for c in children], set(), []
        heapify(heap)
        while heap:
            c = heappop(heap)[1]
            if c in done:
                continue
            done.add(c)
            order.append(c)
            for following, n in after.get(c, ()):
                before[following] -= n
                if following not in done:
                    heappush(heap, (before[following], following))
        todo += [(here, c, children[c]) for c in reversed(order)]
    return json.dumps({"n": 0, "w": [list(x) for x in every]})


@deep_trees()
def aligned(above: list[int], keys: list[str], paths: list[int], at: list[int], texts: list[int], template: Slot) -> list[tuple[int, int | None]]:
    """(path, null) of the slots of a page that simple tree matching aligns with the template's, and (path, text) of the template's texts in them."""
    slots: list[Slot] = []
    for up, key in zip(above, keys):
        slots.append(slots[up].child(key) if slots else Slot(key))
    for i, t in zip(at, texts):
        slots[i].texts[t] = 1
    places = {id(s): i for i, s in enumerate(slots)}
    pairs: list = []
    match(template, slots[0], pairs)
    out: list[tuple[int, int | None]] = []
    for w, p in pairs:
        own = paths[places[id(p)]]
        out.append((own, None))
        out += [(own, t) for t in p.texts if t in w.texts]
    return out


def pruned(text: str, n: int, constant: dict[int, set[int]]) -> str:
    """The wrapper that is left of a frame when only the constant texts of each path stay."""
    every, paths = [], []
    for above, key, texts in json.loads(text)["w"]:
        paths.append(path(paths[above] if paths else None, key))
        every.append((above, key, sorted(constant.get(paths[-1], set()) & set(texts))))
    return json.dumps({"n": n, "w": _with_texts(every)})


NONE = (0, None)


@deep_trees()
def extract(page: str | None, wrapper: tuple[int, Slot | None] = NONE) -> str:
    """The content of a page: its varying blocks, within the article element if it has one, without noise."""
    if not page:
        return ""
    n, template = wrapper
    root = parse(page)
    slots, found = blocks(root)
    known: dict[int, frozenset] = {}
    if template is not None:
        pairs: list = []
        match(template, slots, pairs)
        known = {id(s): w.texts for w, s in pairs if w.texts}
    varies = [id(slot) not in known or name(text) not in known[id(slot)] for _, slot, text in found]
    sizes: dict[int, int] = {}
    for (node, _, text), own in zip(found, varies):
        if own:
            sizes[id(node)] = sizes.get(id(node), 0) + len(text)
    regions, mains = _regions(root, sizes, n >= LEAST_PAGES)
    inside = {place: i for i, region in enumerate(regions) for place in _below(region)}
    below, last = False, None  # whether something varies between here and the next heading of the region
    for i in range(len(found) - 1, -1, -1):
        node = found[i][0]
        own = inside.get(id(node))
        below, last = below and own == last, own
        if node.tag in HEADINGS:
            varies[i] |= mains and below and own is not None  # a heading that every article has, over its own text
            below = False
        else:
            below |= varies[i]
    kept = [(node, text) for (node, _, text), own in zip(found, varies) if own]
    at = [i for i, (node, _) in enumerate(kept) if id(node) in inside]
    if mains and at and not any(kept[i][0].tag == "h1" for i in at):
        title = [i for i in range(at[0]) if kept[i][0].tag == "h1"]  # the title may stand before the article
        at = title[-1:] + at
    return "\n".join(kept[i][1] for i in at)


def _below(region: Node) -> set[int]:
    out, todo = set(), [region]
    while todo:
        n = todo.pop()
        out.add(id(n))
        todo += [c for c in n.children if isinstance(c, Node)]
    return out


def _regions(root: Node, sizes: dict[int, int], known: bool) -> tuple[list[Node], bool]:
    """The elements that hold the content, and whether they are such by name: an article or main element, or sibling articles, else all of the page.

    Where no wrapper tells template from content, bare blocks beside one with
    most of the text are left out, but no headings and paragraphs.
    """
    total: dict[int, int] = {}
    worded: dict[int, bool] = {}
    mains: list[Node] = []
    parents: dict[int, Node] = {}

    def measure(n: Node, in_main: bool) -> None:
        size, words = sizes.get(id(n), 0), n.tag in TEXT_TAGS and id(n) in sizes
        for c in n.children:
            if isinstance(c, Node) and not c.noise:
                if c.tag in MAIN_TAGS and not in_main:
                    mains.append(c)
                    parents[id(c)] = n
                measure(c, in_main or c.tag in MAIN_TAGS)
                size, words = size + total[id(c)], words or worded[id(c)]
        total[id(n)], worded[id(n)] = size, words

    measure(root, False)
    if mains:
        best = max(mains, key=lambda m: total[id(m)])
        if best.tag == "main":
            inner = [c for c in best.children if isinstance(c, Node) and c.tag in MAIN_TAGS and not c.noise]
            return inner or [best], True
        return [m for m in mains if m.tag == best.tag and parents[id(m)] is parents[id(best)]], True
    node = root
    while not known:
        parts = [c for c in node.children if isinstance(c, Node) and not c.noise]
        top = max(parts, key=lambda c: total[id(c)], default=None)
        if top is None or top.tag not in BLOCKS or top.tag in TEXT_TAGS or total[id(top)] < 0.7 * total[id(node)] or any(worded[id(c)] for c in parts if c is not top):
            break
        node = top
    return [node], False
