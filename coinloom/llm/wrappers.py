"""Main text of web pages through wrappers: union-free regular expressions inferred for each host.

A page is a stream of block tags and texts. Its stream folds into a wrapper: equal neighbours, and equal
runs of them, become repeated groups. The wrappers of a host's pages are aligned one after another,
level by level: what one side lacks becomes optional, a text that differs becomes a slot, one that is
the same everywhere stays fixed. The main region is the element that holds most of the text in slots;
elements inside it whose texts stayed fixed over the host's pages belong to the template and are left
out. Where alignment has nothing to compare (a host with one page), and for elements that vary like the
article does (comments, adverts, menus), tags and words in class, id or role decide.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinloom.llm.kernels import pieces as slices
from coinloom.operators.scratch import staged

# A value in quotes may hold ">". A tag whose quote never ends stops at its first ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|</?[a-zA-Z](?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|(?=[^"'])))*+>"""
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_OPENED = re.compile(r"<[a-zA-Z/!?]")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
CONTAINER = frozenset("article blockquote body center details div figure main section table tbody td th tr".split())
BOILER_TAGS = frozenset(
    "head title nav footer aside form button select menu dialog label input option noscript iframe svg object".split()
)
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_SCOPE = CONTAINER | {"li", "dd", "dt", "aside", "footer", "header", "nav", "form", "ul", "ol"}
# A class, id or role marks a part beside the article if it is made of these words ...
_BOILER = frozenset(
    "nav navbar navigation menu masthead footer sidebar sidenav aside ad ads adv advert adverts advertisement advertising "
    "banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification disclaimer alert "
    "popup modal overlay newsletter subscribe signup login search comment comments commentlist reply replies respond "
    "disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager widget toolbar contentinfo "
    "complementary form".split()
)
# ... and of these, which say nothing by themselves.
_PLAIN = frozenset(
    "site main top bottom left right inner outer wrap wrapper container box bar block list item items link links section "
    "area zone slot unit holder content post posts page pages entry articles primary secondary header head body title text "
    "button buttons icon icons group panel placeholder row col column the and us our by article story blog news user reader "
    "media email policy privacy legal global primary leaderboard rail sticky fixed mobile desktop inline space frame label count "
    "field".split()
)
# Kinds of elements whose class words do not count: single paragraphs, headings and cells.
_LINES = frozenset("p h1 h2 h3 h4 h5 h6 dt dd td th tr tbody pre blockquote figcaption caption main".split())
# Kinds that lead up to or close a text.
_HEADED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote".split())
# Kinds of elements that are left out where their text stayed fixed over a host's pages.
_TEMPLATE = frozenset("address center details div dl figure header hr ol p pre section table ul".split())

# Share of a host's slots that an article or main element must hold, or any other, to be its main region.
NAMED, MOST = 0.5, 0.7
# A text that is the same on so many pages, and on half of a host's pages, is fixed.
FIXED_PAGES = 3
# Blocks nested deeper than this count as breaks only.
DEEPEST = 200
# Items that a host's wrapper holds at most: beyond it, optional items of the fewest pages go.
MOST_ITEMS = 4_000


@lru_cache(maxsize=20_000)
def _label(tag: str) -> tuple[str, str, bool, bool]:
    """(name, label, closing, boilerplate) of a tag as written; digits in a label count alike."""
    closing = tag[1] == "/"
    name = re.match(r"[a-zA-Z][^\s/>]*", tag[1 + closing :])[0].lower()
    if closing:
        return name, f"/{name}", True, False
    marks = [" ".join(x for x in m[1:] if x).lower() for m in _ATTRIBUTE.findall(tag)]
    label = re.sub(r"\d+", "0", ".".join([name, *sorted(marks)])).replace("/", " ")
    return name, label, False, name in BOILER_TAGS or _hinted(name, " ".join(marks))


def _hinted(name: str, marks: str) -> bool:
    """Whether one of the marks is made of words of parts beside the article, and of plain ones."""
    if name in _LINES:
        return False
    for mark in marks.split():
        words = [w for w in re.split(r"[^a-z]+", mark) if w]
        if any(w in _BOILER for w in words) and all(w in _BOILER or w in _PLAIN for w in words):
            return True
    return False


def events(page: str) -> list[tuple]:
    """("open", name, label, boilerplate), ("close", name), ("break",), ("text", words), with implied ends.

    The tags html and body are left out: a page is one body, whether it says so or not. An unfinished
    tag at the end is dropped.
    """
    cut = page.rfind(">") + 1
    rest = _OPENED.search(page, cut)
    out: list[tuple] = []
    stack: list[str] = []
    opened: Counter[str] = Counter()

    def close_through(i: int) -> None:
        while len(stack) > i:
            name = stack.pop()
            opened[name] -= 1
            out.append(("close", name))

    def last(names: frozenset | set, scope: frozenset | set) -> int:
        if not any(opened[n] for n in names):
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in names:
                return i
            if stack[i] in scope:
                return -1
        return -1

    for m in _TOKEN.finditer(page, 0, rest.start() if rest else len(page)):
        token = m[0]
        if token[0] != "<" or token == "<":
            out.append(("text", token))
            continue
        if m[1] or token[1] in "!?":
            continue  # comments, declarations and raw elements hold no text
        name, label, closing, boiler = _label(token)
        if name in ("html", "body"):
            out.append(("break",))
            continue
        if closing:
            i = last({name}, frozenset())
            if i >= 0:
                close_through(i)
            elif name in BLOCK:
                out.append(("break",))
            continue
        if name in BLOCK:
            i = last({"p"}, _P_SCOPE)
            if i >= 0:
                close_through(i)
        if name in _CLOSED_BY:
            ends, scope = _CLOSED_BY[name]
            i = last(ends, scope)
            while i >= 0:
                close_through(i)
                i = last(ends, scope)
        out.append(("open", name, label, boiler))
        if name in VOID or token.endswith("/>"):
            out.append(("close", name))
        else:
            stack.append(name)
            opened[name] += 1
    close_through(0)
    return out


# An item of a wrapper is a list: its label ("#" for a text, "(...)" for a group), whether it is optional, whether it
# repeats, on how many pages it is, and then for a text: its hash or None for a slot, its length on all pages, and the
# length of it in links; for others: the items inside.
LABEL, OPTIONAL, REPEATED, PAGES, INSIDE = range(5)
FIXED, LENGTH, LINKED = 4, 5, 6


def _item(label: str, inside: list) -> list:
    return [label, False, False, 1, inside]


def _merge(a: list, b: list, same_page: bool) -> list:
    """Two items of one label as one; on the same page they are repeats of each other."""
    pages = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    head = [a[LABEL], a[OPTIONAL] and b[OPTIONAL] if same_page else a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], pages]
    if a[LABEL] == "#":
        return [*head, a[FIXED] if a[FIXED] == b[FIXED] else None, a[LENGTH] + b[LENGTH], a[LINKED] + b[LINKED]]
    return [*head, _aligned(a[INSIDE], b[INSIDE], same_page)]


def _aligned(a: list, b: list, same_page: bool = False) -> list:
    """Two rows of items as one: a common subsequence of labels, and the rest, which becomes optional."""
    if [x[LABEL] for x in a] != [x[LABEL] for x in b]:
        units = {x[LABEL]: [y[LABEL] for y in x[INSIDE]] for x in (*a, *b) if x[LABEL][0] == "("}
        if units:
            a, b = _grouped(a, units), _grouped(b, units)
    out, i, j = [], 0, 0
    for p, q in [*_common([x[LABEL] for x in a], [x[LABEL] for x in b]), (len(a), len(b))]:
        for x in (*a[i:p], *b[j:q]):
            out.append([x[LABEL], True, *x[2:]])
        if p < len(a):
            out.append(_merge(a[p], b[q], same_page))
        i, j = p + 1, q + 1
    return out


def _grouped(row: list, units: dict[str, list[str]]) -> list:
    """The row with single occurrences of known groups as groups too."""
    out, i = [], 0
    order = sorted(units.items(), key=lambda u: (-len(u[1]), u[0]))
    while i < len(row):
        for label, unit in order:
            n = len(unit)
            if [x[LABEL] for x in row[i : i + n]] == unit:
                pages = max(x[PAGES] for x in row[i : i + n])
                out.append([label, all(x[OPTIONAL] for x in row[i : i + n]), False, pages, row[i : i + n]])
                i += n
                break
        else:
            out.append(row[i])
            i += 1
    return out


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence of two rows of labels, in order.

    Labels that each row has once are anchors; the stretches between anchors, if short, are matched by
    the longest common subsequence, and long ones in their order. Memory grows with the rows, not
    with their product.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), True)]
    while todo:
        i, p, j, q, split = todo.pop()
        while i < p and j < q and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < p and j < q and a[p - 1] == b[q - 1]:
            p, q = p - 1, q - 1
            out.append((p, q))
        if i == p or j == q:
            continue
        if split and (p - i) * (q - j) > 2_500:
            anchors = _anchors(a, b, i, p, j, q)
            if anchors:
                for x, y in [*anchors, (p, q)]:
                    todo.append((i, x, j, y, False))
                    i, j = x + 1, y + 1
                out += anchors
                continue
        out += _longest(a, b, i, p, j, q) if (p - i) * (q - j) <= 40_000 else _in_order(a, b, i, p, j, q)
    return sorted(out)


def _anchors(a: list[str], b: list[str], i: int, p: int, j: int, q: int) -> list[tuple[int, int]]:
    """The longest rising row of labels that both stretches have exactly once."""
    once_a, once_b = Counter(a[i:p]), Counter(b[j:q])
    place = {x: k for k, x in enumerate(b[j:q], j) if once_b[x] == 1}
    pairs = [(k, place[x]) for k, x in enumerate(a[i:p], i) if once_a[x] == 1 and x in place]
    ends: list[int] = []
    tails: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(ends, y)
        before[k] = tails[at - 1] if at else -1
        ends[at : at + 1], tails[at : at + 1] = [y], [k]
    out, k = [], tails[-1] if tails else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _longest(a: list[str], b: list[str], i: int, p: int, j: int, q: int) -> list[tuple[int, int]]:
    length = [[0] * (q - j + 1) for _ in range(p - i + 1)]
    for x in range(p - i - 1, -1, -1):
        here, below = length[x], length[x + 1]
        for y in range(q - j - 1, -1, -1):
            here[y] = below[y + 1] + 1 if a[i + x] == b[j + y] else max(below[y], here[y + 1])
    out, x, y = [], 0, 0
    while x < p - i and y < q - j:
        if a[i + x] == b[j + y]:
            out.append((i + x, j + y))
            x, y = x + 1, y + 1
        elif length[x + 1][y] >= length[x][y + 1]:
            x += 1
        else:
            y += 1
    return out


def _in_order(a: list[str], b: list[str], i: int, p: int, j: int, q: int) -> list[tuple[int, int]]:
    """Each label of a with its next place in b, if b has it after the last match and not too far on."""
    places: dict[str, list[int]] = {}
    for k in range(j, q):
        places.setdefault(b[k], []).append(k)
    out, at = [], j
    for x in range(i, p):
        have = places.get(a[x], [])
        k = bisect_left(have, at)
        if k < len(have) and have[k] - at <= 64:
            out.append((x, have[k]))
            at = have[k] + 1
    return out


def _folded(row: list) -> list:
    """Equal neighbours become one repeated item, then equal runs of up to 6 items one repeated group."""
    out: list = []
    for x in row:
        if out and out[-1][LABEL] == x[LABEL]:
            out[-1] = _merge(out[-1], x, True)
            out[-1][REPEATED] = True
        else:
            out.append(x)
    labels = [x[LABEL] for x in out]
    done: list = []
    i = 0
    while i < len(out):
        size = next((k for k in range(2, min(6, (len(out) - i) // 2) + 1) if labels[i : i + k] == labels[i + k : i + 2 * k]), 0)
        if not size:
            done.append(out[i])
            i += 1
            continue
        group = ["(" + " ".join(labels[i : i + size]) + ")", False, True, 1, out[i : i + size]]
        i += size
        while labels[i : i + size] == labels[i - size : i]:
            group = _merge(group, [group[LABEL], False, True, 1, out[i : i + size]], True)
            i += size
        done.append(group)
    return done


class Wrapper:
    """The items of a host's pages, aligned, and the number of pages."""

    def __init__(self, items: list, pages: int = 1) -> None:
        self.items, self.pages = items, pages

    @staticmethod
    def of(stream: list[tuple]) -> Wrapper:
        """A page's own wrapper: all its texts are fixed until another page differs."""
        rows: list[list] = [[]]
        labels: list[str] = []
        shown: list[bool] = []  # for each open tag, whether it has a row of items
        said: list[str] = []
        links = linked = 0

        def flush() -> None:
            nonlocal linked
            words = _SPACE.sub(" ", "".join(said)).strip()
            said.clear()
            if words:
                rows[-1].append(["#", False, False, 1, crc32(words.encode()), len(words), min(linked, len(words))])
            linked = 0

        for e in stream:
            if e[0] == "text":
                said.append(e[1])
                linked += len(e[1]) if links else 0
            elif e[0] == "break":
                flush()
            elif e[0] == "open":
                links += e[1] == "a"
                block = e[1] in BLOCK and len(rows) <= DEEPEST
                if e[1] in BLOCK:
                    flush()
                if block:
                    rows.append([])
                    labels.append(e[2])
                elif e[1] == "br":
                    said.append(" ")
                shown.append(block)
            else:
                links -= e[1] == "a"
                if e[1] in BLOCK:
                    flush()
                if shown.pop():
                    inside = _folded(rows.pop())
                    rows[-1].append(_item(labels.pop(), inside))
        flush()
        return Wrapper(_folded(rows[0]))

    def form(self) -> str:
        """The wrapper's tags and slots alone: pages of equal form need no alignment."""
        def show(x: list) -> str:
            return "#" if x[LABEL] == "#" else f"{x[LABEL]}{'+' if x[REPEATED] else ''}<{' '.join(map(show, x[INSIDE]))}>"

        return " ".join(map(show, self.items))

    def merge(self, other: Wrapper) -> None:
        """Align another wrapper of the host to this one."""
        self.items, self.pages = _aligned(self.items, other.items), self.pages + other.pages
        if self.pages > 1:
            self._slimmed()

    def _slimmed(self) -> None:
        def count(row: list) -> int:
            return len(row) + sum(count(x[INSIDE]) for x in row if x[LABEL] != "#")

        def texts(x: list) -> list[tuple[int, int]]:
            """Length and linked length of the texts of an item, outside menus and the like."""
            if x[LABEL] == "#":
                return [(x[LENGTH], x[LINKED])]
            name, _, marks = x[LABEL].partition(".")
            if x[LABEL][0] != "(" and (name in BOILER_TAGS or _hinted(name, marks.replace(".", " "))):
                return []
            return [t for y in x[INSIDE] for t in texts(y)]

        def kept(row: list) -> list:
            """The row with its rare items as one slot at the end: what varied stays known to vary, and how long it was."""
            rare = [x for x in row if x[OPTIONAL] and x[PAGES] <= limit]
            out = [x if x[LABEL] == "#" else [*x[:INSIDE], kept(x[INSIDE])] for x in row if not (x[OPTIONAL] and x[PAGES] <= limit)]
            held = [t for x in rare for t in texts(x)]
            if held:
                slot = ["#", True, True, max(x[PAGES] for x in rare), None, sum(n for n, _ in held), sum(n for _, n in held)]
                if out and out[-1][LABEL] == "#" and out[-1][FIXED] is None:
                    slot = _merge(out.pop(), slot, True)
                out.append(slot)
            return out

        limit = 0
        while self.pages > 2 and limit < self.pages and count(self.items) > MOST_ITEMS:
            limit = 2 * limit + 1
            self.items = kept(self.items)

    def _fixed(self, x: list) -> bool:
        return x[FIXED] is not None and x[PAGES] >= FIXED_PAGES and 2 * x[PAGES] >= self.pages

    def _slots(self, hints: bool, only_slots: bool) -> dict[str, int]:
        """Length of the texts in each container, by its path: those in slots, outside links, menus, forms and the
        like and, with `hints`, outside parts that class words mark."""
        mass: dict[str, int] = {"": 0}

        def walk(row: list, path: str, holders: list[str]) -> None:
            for x in row:
                label = x[LABEL]
                if label == "#":
                    n = 0 if only_slots and self._fixed(x) else x[LENGTH] - (x[LINKED] if only_slots else 0)
                    for h in holders:
                        mass[h] = mass.get(h, 0) + n
                elif label[0] == "(":
                    walk(x[INSIDE], path, holders)
                else:
                    name, _, marks = label.partition(".")
                    if name in BOILER_TAGS or (hints and _hinted(name, marks.replace(".", " "))):
                        continue
                    here = f"{path}/{label}"
                    walk(x[INSIDE], here, [*holders, here] if name in CONTAINER and here not in holders else holders)

        walk(self.items, "", [""])
        return mass

    def region(self) -> str:
        """Path of the main element ("" for the whole page): an article or main element if one holds at least half
        of the text in slots, else the innermost element that holds most of it, with what heads and closes it."""
        mass = self._slots(True, True)
        free = self._slots(False, True)
        if 10 * mass[""] < free[""]:
            mass = free  # nearly everything lies under a marked element: the mark means something else
        if not mass[""]:
            mass = self._slots(True, False)
        total = mass[""]
        if not total:
            return ""
        kind = lambda k: k.rsplit("/", 1)[-1].split(".")[0]
        named = [k for k in mass if kind(k) in ("article", "main") and mass[k] >= NAMED * total]
        if named:
            best = max(named, key=lambda k: (mass[k], k))
            inner = [k for k in named if kind(k) == "article" and mass[k] >= 0.9 * mass[best]]
            return min(inner or [best], key=lambda k: (mass[k], -k.count("/"), k))
        best = min((k for k in mass if mass[k] >= MOST * total), key=lambda k: (-k.count("/"), mass[k], k))
        # Headings and paragraphs that vary right beside it belong to it: a title above, closing words below.
        lines = self._lines()
        while best and (above := best.rpartition("/")[0]) and lines.get(above):
            best = above
        return best

    def _lines(self) -> dict[str, int]:
        """Length of the varying texts, outside links, in headings and paragraphs right below each container, by its path."""
        found: dict[str, int] = {}

        def varying(row: list) -> int:
            return sum(varying(x[INSIDE]) if x[LABEL] != "#" else 0 if self._fixed(x) else x[LENGTH] - x[LINKED] for x in row)

        def walk(row: list, path: str) -> None:
            for x in row:
                name = x[LABEL].partition(".")[0]
                if x[LABEL][0] == "(":
                    walk(x[INSIDE], path)
                elif name in CONTAINER:
                    walk(x[INSIDE], f"{path}/{x[LABEL]}")
                elif name in _HEADED:
                    found[path] = found.get(path, 0) + varying(x[INSIDE])

        walk(self.items, "")
        return found

    def template(self, region: str) -> list[str]:
        """Paths inside the region of elements whose texts all stayed fixed: adverts, notices and the like.

        Inside an article or main element only those of which half is links: a byline or a table that
        all pages share belongs to the article. None where such elements hold half of the region's
        text: then the pages are copies of each other.
        """
        fixed: dict[str, bool] = {}
        length: dict[str, int] = {}
        linked: dict[str, int] = {}

        def walk(row: list, path: str) -> tuple[bool, int, int]:
            whole, size, links = True, 0, 0
            for x in row:
                if x[LABEL] == "#":
                    whole &= self._fixed(x)
                    size, links = size + x[LENGTH], links + x[LINKED]
                    continue
                group = x[LABEL][0] == "("
                here = path if group else f"{path}/{x[LABEL]}"
                same, n, m = walk(x[INSIDE], here)
                whole, size, links = whole and same, size + n, links + m
                if not group:
                    fixed[here] = fixed.get(here, True) and same and n > 0
                    length[here] = length.get(here, 0) + n
                    linked[here] = linked.get(here, 0) + m
            return whole, size, links

        walk(self.items, "")
        kind = lambda k: k.rsplit("/", 1)[-1].split(".")[0]
        named = any(kind(part) in ("article", "main") for part in region.split("/"))
        inside = [k for k in fixed if k.startswith(f"{region}/")]
        drop = [k for k in inside if fixed[k] and kind(k) in _TEMPLATE and (not named or 2 * linked[k] >= length[k])]
        drop = sorted(k for k in drop if not any(k.startswith(f"{d}/") for d in drop))
        total = length.get(region, sum(n for k, n in length.items() if k.count("/") == 1))
        return drop if 2 * sum(length[k] for k in drop) < total else []

    def pattern(self) -> str:
        """The wrapper written as a union-free regular expression."""

        def show(x: list) -> str:
            if x[LABEL] == "#":
                one = f"={x[FIXED]:08x}" if self._fixed(x) else "#"
            else:
                inside = " ".join(map(show, x[INSIDE]))
                one = inside if x[LABEL][0] == "(" else " ".join(filter(None, [x[LABEL], inside, f"/{x[LABEL].split('.')[0]}"]))
            one = f"({one})+" if x[REPEATED] else one
            return f"({one})?" if x[OPTIONAL] else one

        return " ".join(map(show, self.items))

    def dump(self) -> str:
        return json.dumps([self.items, self.pages])

    @staticmethod
    def load(text: str) -> Wrapper:
        return Wrapper(*json.loads(text))


def main_text(page: str, region: str, template: frozenset[str] = frozenset()) -> str:
    """Blocks of the page inside the elements at the path `region`, joined by newlines.

    Where the page has no such element, the region is found from the page alone. Elements at a path of
    `template`, menus, adverts, comments and the like are left out, with all they hold.
    """
    stream = events(page)
    text = _inside(stream, region, template)
    if text is None:
        text = _inside(stream, Wrapper.of(stream).region(), frozenset())
    return text or ""


def _inside(stream: list[tuple], region: str, template: frozenset[str]) -> str | None:
    blocks: list[str] = []
    parts: list[str] = []
    paths = [""]
    stack: list[tuple[bool, bool, bool]] = []  # has a path, is the region, is left out
    inside, skipped, seen = int(region == ""), 0, region == ""

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            blocks.append(text)

    for e in stream:
        if e[0] == "text":
            if inside and not skipped:
                parts.append(e[1])
            continue
        if e[0] == "break" or e[1] in BLOCK:
            flush()
        if e[0] == "open":
            if e[1] == "br":
                parts.append(" ")
            block = e[1] in BLOCK and len(paths) <= DEEPEST
            if block:
                paths.append(f"{paths[-1]}/{e[2]}")
            here = block and paths[-1] == region
            # A header belongs to a page that is all region only inside an article or main element.
            outer = e[1] == "header" and not region and not any(p in paths[-1] for p in ("/article", "/main"))
            out = bool(inside) and not here and (e[3] or outer or (block and paths[-1] in template))
            stack.append((block, here, out))
            inside, skipped, seen = inside + here, skipped + out, seen or here
        elif e[0] == "close":
            block, here, out = stack.pop()
            if block:
                paths.pop()
            inside, skipped = inside - here, skipped - out
    flush()
    return "\n".join(blocks) if seen else None


def _host(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))


def infer_wrappers(pages: DataFrame, most_forms: int = 4_000) -> DataFrame:
    """`host, n_pages, pattern, region, template` of every host.

    Each task folds and aligns its own pages first and hands out one wrapper per host (and starts anew
    when it holds `most_forms` forms of pages); then a host's wrappers meet, those of a large host first
    in 64 groups, so that no task holds more than a share of them.
    """
    schema = "host string, salt int, wrapper string"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pages of equal form need no alignment, only their texts are compared.
        have: dict[tuple[str, str], Wrapper] = {}
        salt = TaskContext.get().partitionId() % 64
        for batch in batches:
            for part in slices(batch, "html"):
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    new = Wrapper.of(events(page or ""))
                    key = (host, new.form())
                    if key in have:
                        have[key].merge(new)
                    else:
                        have[key] = new
                if len(have) >= most_forms:
                    yield _rows(_by_host(have), salt)
                    have = {}
        yield _rows(_by_host(have), salt)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[tuple[str, int], Wrapper] = {}
        for batch in batches:
            for host, salt, text in zip(*(batch.column(k).to_pylist() for k in ("host", "salt", "wrapper")), strict=True):
                new = Wrapper.load(text)
                if have and (host, salt) not in have:
                    # sorted by host: the one before is complete
                    yield _rows({h: w for (h, _), w in have.items()}, next(iter(have))[1])
                    have = {}
                if (host, salt) in have:
                    have[host, salt].merge(new)
                else:
                    have[host, salt] = new
        yield _rows({h: w for (h, _), w in have.items()}, next(iter(have))[1] if have else 0)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ws = [Wrapper.load(t) for t in batch.column("wrapper").to_pylist()]
            regions = [w.region() for w in ws]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    pa.array([w.pages for w in ws], pa.int64()),
                    pa.array([w.pattern() for w in ws], pa.string()),
                    pa.array(regions, pa.string()),
                    pa.array([w.template(r) for w, r in zip(ws, regions, strict=True)], pa.list_(pa.string())),
                ],
                ["host", "n_pages", "pattern", "region", "template"],
            )

    partial = pages.select(_host().alias("host"), "html").mapInArrow(local, schema)
    salted = partial.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(meet, schema)
    whole = salted.withColumn("salt", F.lit(0)).repartition("host").sortWithinPartitions("host", "wrapper")
    return whole.mapInArrow(meet, schema).mapInArrow(
        decide, "host string, n_pages long, pattern string, region string, template array<string>"
    )


def _by_host(forms: dict[tuple[str, str], Wrapper]) -> dict[str, Wrapper]:
    """The aligned wrapper of each host's forms."""
    out: dict[str, Wrapper] = {}
    for (host, _), w in forms.items():
        if host in out:
            out[host].merge(w)
        else:
            out[host] = w
    return out


def _rows(have: dict[str, Wrapper], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(have), pa.string()),
            pa.array([salt] * len(have), pa.int32()),
            pa.array([w.dump() for w in have.values()], pa.string()),
        ],
        ["host", "salt", "wrapper"],
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages` (page_id, url, html).

    The text is what the page holds in its host's main region, without the host's template: character
    references decoded, white space inside a block one blank, blocks joined by one newline. A null html
    counts as empty; a page without text has an empty one and 0 characters. Pages whose url has no host
    share one wrapper. Repeated rows stay separate; extra columns are ignored.
    """
    regions = staged(infer_wrappers(pages)).select("host", "region", "template")
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", 4096, 1_000_000):
                rows = zip(*(part.column(k).to_pylist() for k in ("html", "region", "template")), strict=True)
                found = [main_text(page or "", region or "", frozenset(template or ())) for page, region, template in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(found, pa.string()),
                        pa.array([len(t) for t in found], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    joined = pages.select("page_id", "url", "html", _host().alias("host")).join(regions, "host", "left")
    return joined.select("page_id", "url", "html", "region", "template").mapInArrow(
        run, f"page_id {kinds['page_id']}, url string, text string, n_chars long"
    )
