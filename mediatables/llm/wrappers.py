"""Main text of web pages by union-free wrappers of their hosts.

A wrapper is a regular expression over page tokens without alternatives:
elements (a start tag, a sequence, an end tag), text slots, groups, and on
each of them a mark for "may be absent" and one for "may repeat". It is
inferred from token streams alone:

1. a page's stream is balanced (end tags that HTML lets authors leave out) and
   folded: where a label comes again in a sequence, the stretches that begin
   with it are aligned with each other and become one repeated item;
2. two wrappers of a host are aligned, sequence by sequence, along a longest
   common subsequence of labels; what only one has becomes optional, texts
   that differ become slots, repeats are folded again.

After folding no label occurs twice in a sequence, so a wrapper's size is that
of the template and not that of its pages, and a page is read by following
labels. Every page of a host takes part: tasks fold their own pages into one
wrapper per host, and these are aligned in rounds, ``FAN_IN`` at a time.

The wrapper tells where a page's content is: its ``article`` elements, else
``main``, else elements named as content, else the element that holds most of
the text outside links. In it, menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are left out, known by tag,
role, class or id. Only where no element says that it is the content, a slot
whose text is the same on three pages or more is taken for page furniture.

Defined results:
- null and empty html gives an empty text; a null url is a host of its own
- repeated rows and ids give one result each; other columns are ignored
- a page may end anywhere; unclosed elements end with it
- elements more than ``DEEPEST`` levels down separate blocks and have no labels
- an ``h1`` to ``h6`` in a ``header`` inside the content is kept
- an empty table gives an empty result
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import batch_conf, text_list, text_of, written

FAN_IN = 64
# Hosts that a task holds wrappers of before it writes them out.
HELD_HOSTS = 2_000
# Levels of a page tree; elements below only separate blocks.
DEEPEST = 200
# Pages with the same text in a slot from which it counts as furniture.
FURNITURE_PAGES = 3

# Element names of HTML.
BLOCKS = frozenset("""
address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu
nav noscript object ol optgroup option p pre search section select summary svg table tbody td template textarea
tfoot th thead title tr ul video audio math""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "xmp")
# A start tag of the key ends an open element of these names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tr": {"td", "th", "tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"td", "th", "tr", "thead", "tbody"},
    "thead": {"td", "th", "tr"}, "tfoot": {"td", "th", "tr", "thead", "tbody"}, "body": {"head"},
}
SCOPES = {"ul": "li", "ol": "li", "dl": "dt", "table": "tr", "select": "option", "menu": "li"}

# Elements, roles and words of class or id that are not content.
DROPPED = frozenset("""
nav header footer aside form button select textarea dialog menu search head title script style noscript template
iframe svg canvas object video audio math xmp fieldset""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                          "menubar toolbar".split())
DROPPED_WORDS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner
cookie cookies consent gdpr notice notices notification popup modal overlay alert newsletter subscribe signup
sidebar sidebars aside widget widgets menu menus nav navbar navigation navi topnav breadcrumb breadcrumbs
pagination pager toolbar topbar masthead header footer copyright comment comments commentlist respond replies
reply disqus share sharing social related recommended login search form hidden""".split())
CONTENT_WORDS = frozenset("content article post entry story maincontent articlebody postbody entrycontent".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?P<rawattrs>[^>]*)>(?P<body>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)


# Page trees: an element is [label, children]; a text is (characters, in links).
def _label(name: str, attributes: str) -> str:
    """Name and the marks that matter: role, and words of class and id
    without those that hold digits."""
    if not attributes or attributes.isspace():
        return name
    return _label_of(name, attributes.strip())


@lru_cache(10_000)
def _label_of(name: str, attributes: str) -> str:
    marks: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if kind == "hidden":
            marks.add(".hidden")
        elif kind == "style":
            if _HIDDEN_STYLE.search(value):
                marks.add(".hidden")
        elif kind == "role":
            marks.add(f"@{value}")
        else:
            for word in value.split():
                if not any(c.isdigit() for c in word):
                    marks.add(f".{word}")
    return name + "".join(sorted(marks))


@lru_cache(10_000)
def _dropped(label: str) -> bool:
    """Whether an element with this label is never content."""
    name, *marks = re.split(r"(?=[.@])", label)
    if name in DROPPED:
        return True
    for mark in marks:
        if mark[0] == "@":
            if mark[1:] in DROPPED_ROLES:
                return True
        else:
            words = re.split(r"[-_:]+", mark[1:])
            if not CONTENT_WORDS.isdisjoint(words) and DROPPED_WORDS.isdisjoint(words[:1]) and len(words) > 1:
                # "post-header" is dropped, "content-with-sidebar" is not.
                if words[-1] not in DROPPED_WORDS or "with" in words or "has" in words:
                    continue
            if not DROPPED_WORDS.isdisjoint(words):
                return True
    return False


@lru_cache(10_000)
def _content_rank(label: str) -> int:
    """0: article, 1: main, 2: named as content, 3: none of these."""
    name, *marks = re.split(r"(?=[.@])", label)
    if name == "article" or "@article" in marks:
        return 0
    if name == "main" or "@main" in marks:
        return 1
    if name in ("div", "section", "td") and any(
            mark[0] == "." and not CONTENT_WORDS.isdisjoint(re.split(r"[-_:]+", mark[1:])) for mark in marks):
        return 2
    return 3


def page_tree(html: str) -> list:
    """The balanced tree of a page's block elements. Inline elements are part
    of the texts around them unless they are never content."""
    root: list = ["", []]
    stack = [root]
    here: list = root[1]
    text: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            if words:
                here.append((words, linked))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal here
        del stack[depth:]
        here = stack[-1][1]

    for m in _TOKEN.finditer(html):
        plain = m["text"]
        if plain is not None:
            if "&" in plain:
                plain = html_lib.unescape(plain)
            text.append(plain)
            if in_link:
                linked += len(plain)
            continue
        if m["raw"] is not None:
            name = m["raw"].lower()
            if name == "xmp":
                text.append(m["body"])
            elif name in BLOCKS:
                flush()
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            text.append(" ")
        elif name in VOID and name != "hr":
            continue
        elif m["close"]:
            if name == "a":
                in_link = 0
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][2] == name), 0)
            if depth:
                flush()
                close(depth)
            elif name in BLOCKS:
                flush()
        else:
            attributes = m["attrs"]
            if name in BLOCKS:
                flush()
                if name == "hr":
                    continue
                if stack[-1] is not root and stack[-1][2] == "p":
                    close(len(stack) - 1)
                ended = ENDS.get(name)
                if ended:
                    for k in range(len(stack) - 1, 0, -1):
                        open_name = stack[k][2]
                        if open_name in ended:
                            close(k)
                        elif open_name in SCOPES:
                            break
                label = _label(name, attributes)
                if len(stack) > DEEPEST:
                    continue
            else:
                if name == "a":
                    in_link = 1
                if not attributes:
                    continue
                label = _label(name, attributes)
                if label == name or not _dropped(label):
                    continue
                flush()
            if attributes.endswith("/") and name in ("svg", "math", "object"):
                continue
            node = [label, [], name]
            here.append(node)
            stack.append(node)
            here = node[1]
    flush()
    return root[1]


# Wrappers. An item is (label, optional, repeated, body, fixed, chars, linked):
# "#" a text slot (fixed: hash of its one text, or None), "()" a group, else an
# element. Body: a tuple of items. chars, linked: text seen, and that in links.
Item = tuple
Sequence = tuple


def _labels(item: Item) -> set[str]:
    if item[0] != "()":
        return {item[0]}
    return set().union(*map(_labels, item[3]))


def _loose(item: Item) -> Item:
    return item if item[1] else (item[0], True, *item[2:])


def _joined(a: Item, b: Item) -> Item:
    """One item for two that share a label."""
    if a[0] == b[0] == "#":
        return ("#", a[1] or b[1], a[2] or b[2], (), a[4] if a[4] == b[4] else None, a[5] + b[5], a[6] + b[6])
    if a[0] == b[0] and a[0] != "()":
        return (a[0], a[1] or b[1], a[2] or b[2], merge(a[3], b[3]), None, a[5] + b[5], a[6] + b[6])
    left = a[3] if a[0] == "()" else ((a[0], False, *a[2:]),)
    right = b[3] if b[0] == "()" else ((b[0], False, *b[2:]),)
    body = merge(left, right)
    repeated = a[2] or b[2]
    return ("()", a[1] or b[1], repeated, body, None, a[5] + b[5], a[6] + b[6])


def _run(items: list[Item]) -> list[Item]:
    """Neighbours with one label as one repeated item."""
    out: list[Item] = []
    for item in items:
        if out and out[-1][0] == item[0] != "()":
            one = _joined(out[-1], item)
            out[-1] = (one[0], out[-1][1] and item[1], True, *one[3:])
        else:
            out.append(item)
    return out


def fold(items: list[Item]) -> Sequence:
    """A sequence in which no label comes twice."""
    items = _run(items)
    while True:
        held = [_labels(x) for x in items]
        last: dict[str, int] = {}
        for k, labels in enumerate(held):
            for label in labels:
                last[label] = k
        start = next((k for k, labels in enumerate(held) if any(last[x] > k for x in labels)), None)
        if start is None:
            return tuple(items)
        # The stretch beyond which none of its labels occurs again.
        end = k = start
        while k <= end:
            end = max(end, *(last[x] for x in held[k]))
            k += 1
        # Stretches that begin with the first label that comes again.
        heads = {x for x in held[start] if last[x] > start}
        pieces: list[list[Item]] = []
        for k in range(start, end + 1):
            if not pieces or held[k] & heads:
                pieces.append([])
            pieces[-1].append(items[k])
        body = fold(pieces[0])
        for piece in pieces[1:]:
            body = merge(body, fold(piece))
        if len(body) == 1:
            group = (body[0][0], body[0][1], True, *body[0][3:])
        else:
            group = ("()", False, True, body, None, sum(x[5] for x in body), sum(x[6] for x in body))
        items = _run([*items[:start], group, *items[end + 1:]])


def merge(a: Sequence, b: Sequence) -> Sequence:
    """The alignment of two sequences."""
    if len(a) == len(b) and all(x[0] == y[0] != "()" for x, y in zip(a, b)):
        return tuple(_joined(x, y) for x, y in zip(a, b))
    left, right = [_labels(x) for x in a], [_labels(x) for x in b]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1],
                             best[i + 1][j + 1] + 1 if left[i] & right[j] else 0)
    out: list[Item] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i] & right[j] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(_joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i][j] == best[i + 1][j]):
            out.append(_loose(a[i]))
            i += 1
        else:
            out.append(_loose(b[j]))
            j += 1
    return fold(out)


def wrapper_of(tree: list) -> Sequence:
    """The folded sequence of one page."""
    items: list[Item] = []
    for node in tree:
        if isinstance(node, tuple):
            words, linked = node
            items.append(("#", False, False, (), xxhash.xxh64_hexdigest(words), len(words), min(linked, len(words))))
        else:
            body = wrapper_of(node[1])
            items.append((node[0], False, False, body, None, sum(x[5] for x in body), sum(x[6] for x in body)))
    return fold(items)


def to_json(pages: int, wrapper: Sequence) -> str:
    return json.dumps([pages, wrapper], separators=(",", ":"))


def from_json(held: str) -> tuple[int, Sequence]:
    def tuples(items: list) -> Sequence:
        return tuple((x[0], x[1], x[2], tuples(x[3]), *x[4:]) for x in items)

    pages, wrapper = json.loads(held)
    return pages, tuples(wrapper)


def expression(wrapper: Sequence) -> str:
    """The wrapper as a regular expression over labels and ``#``."""
    out = []
    for label, optional, repeated, body, *_ in wrapper:
        inner = "#" if label == "#" else expression(body)
        if label not in ("#", "()"):
            inner = f"{re.escape(f'<{label}>')}{inner}{re.escape('</>')}"
        out.append(f"(?:{inner}){'*' if optional and repeated else '+' if repeated else '?' if optional else ''}")
    return "".join(out)


def stream(tree: list) -> str:
    """A page in the alphabet of ``expression``."""
    return "".join("#" if isinstance(x, tuple) else f"<{x[0]}>{stream(x[1])}</>" for x in tree)


class Extractor:
    """Reads pages by a wrapper: its content elements and their slots."""

    def __init__(self, pages: int, wrapper: Sequence) -> None:
        self.wrapper = wrapper
        self._furniture = pages >= FURNITURE_PAGES
        # Ways to the candidates, by rank; and the one with most plain text.
        self.ranked: list[list[tuple[str, ...]]] = [[], [], []]
        self.largest: tuple[str, ...] = ()
        self._find(wrapper, ())
        self._narrow(wrapper, (), self._plain(wrapper))

    def _items(self, sequence: Sequence) -> Iterator[Item]:
        for item in sequence:
            if item[0] == "()":
                yield from self._items(item[3])
            else:
                yield item

    def _find(self, sequence: Sequence, way: tuple[str, ...]) -> None:
        for item in self._items(sequence):
            if item[0] == "#" or _dropped(item[0]):
                continue
            here = (*way, item[0])
            rank = _content_rank(item[0])
            if rank < 3:
                self.ranked[rank].append(here)
            self._find(item[3], here)

    def _plain(self, sequence: Sequence) -> int:
        """Characters outside links and outside what is never content."""
        return sum(x[5] - x[6] if x[0] == "#" else 0 if _dropped(x[0]) else self._plain(x[3])
                   for x in self._items(sequence))

    def _narrow(self, sequence: Sequence, way: tuple[str, ...], total: int) -> None:
        """Go down while one element holds nearly all of the plain text."""
        for item in self._items(sequence):
            if item[0] != "#" and not _dropped(item[0]) and item[0].split(".")[0] not in ("p", *HEADINGS) \
                    and total and 10 * self._plain(item[3]) >= 9 * total:
                self.largest = (*way, item[0])
                self._narrow(item[3], self.largest, total)
                return

    def _at(self, tree: list, way: tuple[str, ...]) -> Iterator[list]:
        """Elements of a page at a way of labels, in page order."""
        for node in tree:
            if isinstance(node, list) and node[0] == way[0]:
                if len(way) == 1:
                    yield node
                else:
                    yield from self._at(node[1], way[1:])

    def _slot(self, sequence: Sequence) -> dict[str, Item]:
        return {x[0]: x for x in self._items(sequence)}

    def _blocks(self, tree: list, sequence: Sequence, named: bool, heading_only: bool = False) -> Iterator[str]:
        slots = self._slot(sequence)
        for node in tree:
            if isinstance(node, tuple):
                fixed = slots.get("#", ("#",) + (None,) * 6)[4]
                if not heading_only and not (fixed is not None and self._furniture and not named):
                    yield node[0]
                continue
            label = node[0]
            body = slots[label][3] if label in slots else ()
            if label.startswith("header") and named and node[2] == "header":
                yield from self._blocks(node[1], body, named, True)
            elif not _dropped(label):
                yield from self._blocks(node[1], body, named, heading_only and node[2] not in HEADINGS)

    def _body(self, way: tuple[str, ...]) -> Sequence:
        sequence = self.wrapper
        for label in way:
            sequence = self._slot(sequence)[label][3]
        return sequence

    def text(self, tree: list) -> str:
        for ways in self.ranked:
            found: list[str] = []
            for way in ways:
                # Content inside content is read with the outer one.
                if any(way[:len(o)] == o for o in ways if o != way):
                    continue
                for node in self._at(tree, way):
                    found.append("\n".join(self._blocks(node[1], self._body(way), True)))
            if any(found):
                if len(ways) > 1:
                    return self._in_order(tree, ways)
                return "\n".join(x for x in found if x)
        if self.largest and any(True for _ in self._at(tree, self.largest)):
            return "\n".join(x for node in self._at(tree, self.largest)
                             for x in self._blocks(node[1], self._body(self.largest), False))
        return "\n".join(self._blocks(tree, self.wrapper, False))

    def _in_order(self, tree: list, ways: list[tuple[str, ...]]) -> str:
        """Texts of several content elements, in page order."""
        wanted = set(ways)

        def walk(nodes: list, way: tuple[str, ...], sequence: Sequence) -> Iterator[str]:
            slots = self._slot(sequence)
            for node in nodes:
                if isinstance(node, tuple) or _dropped(node[0]):
                    continue
                here = (*way, node[0])
                body = slots[node[0]][3] if node[0] in slots else ()
                if here in wanted:
                    yield from self._blocks(node[1], body, True)
                else:
                    yield from walk(node[1], here, body)
        return "\n".join(walk(tree, (), self.wrapper))


def host_of(url_col: str):
    """Lower-cased host of a url; empty for null or without ``://``."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`"), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


WRAPPERS = "host string, salt long, pages long, wrapper string"
_WRAPPER_SCHEMA = pa.schema([("host", pa.string()), ("salt", pa.int64()), ("pages", pa.int64()),
                             ("wrapper", pa.string())])


def _rows(held: dict[str, tuple[int, Sequence]], salt: int) -> pa.RecordBatch:
    hosts = list(held)
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array([salt] * len(hosts), pa.int64()),
         pa.array([held[h][0] for h in hosts], pa.int64()),
         pa.array([to_json(*held[h]) for h in hosts], pa.string())], schema=_WRAPPER_SCHEMA)


def _infer_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of a task's pages."""
    salt = TaskContext.get().partitionId()
    held: dict[str, tuple[int, Sequence]] = {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), text_list(batch.column("html"))):
            wrapper = wrapper_of(page_tree(page))
            known = held.get(host)
            held[host] = (1, wrapper) if known is None else (known[0] + 1, merge(known[1], wrapper))
        if len(held) > HELD_HOSTS:
            yield _rows(held, salt)
            held = {}
    if held:
        yield _rows(held, salt)


def _align_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per (host, salt) of a stream sorted by them."""
    of: tuple[str, int] | None = None
    pages, wrapper = 0, ()
    for batch in batches:
        for host, salt, held in zip(*(batch.column(c).to_pylist() for c in ("host", "salt", "wrapper"))):
            n, other = from_json(held)
            if (host, salt) == of:
                pages, wrapper = pages + n, merge(wrapper, other)
                continue
            if of is not None:
                yield _rows({of[0]: (pages, wrapper)}, of[1])
            of, pages, wrapper = (host, salt), n, other
    if of is not None:
        yield _rows({of[0]: (pages, wrapper)}, of[1])


def host_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, pages, wrapper): the written wrapper of each host."""
    slim = pages.select(host_of(url_col).alias("host"), text_of(html_col).alias("html"))
    with batch_conf(pages.sparkSession):
        held = written(slim.mapInArrow(_infer_kernel, WRAPPERS), "wrappers")
        # Salts are numbers of tasks; each round leaves one wrapper of FAN_IN.
        left = held.agg(F.max("salt")).first()[0] or 0
        while True:
            left //= FAN_IN
            grouped = held.withColumn("salt", F.floor(F.col("salt") / FAN_IN))
            held = written(grouped.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
                           .mapInArrow(_align_kernel, WRAPPERS), "wrappers")
            if not left:
                return held.drop("salt")


def _extract_kernel(id_type: pa.DataType):
    schema = pa.schema([("page_id", id_type), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Extractor] = {}
        for batch in batches:
            texts = []
            for page, held in zip(text_list(batch.column("html")), batch.column("wrapper").to_pylist()):
                if held not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[held] = Extractor(*from_json(held))
                texts.append(known[held].text(page_tree(page)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], schema=schema)
    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Wrappers meet their pages in a join on the host. Spark sends them to every
    task where their files are small enough for that, and else sorts both
    sides; a host with very many pages is then split.
    """
    wrappers = host_wrappers(pages, url_col, html_col).select(F.col("host").alias("of"), "wrapper")
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"), host_of(url_col).alias("host"))
    kind = slim.schema["page_id"].dataType
    met = slim.join(wrappers, F.col("host") == F.col("of")).select("page_id", "url", "html", "wrapper")
    with batch_conf(pages.sparkSession):
        return written(met.mapInArrow(
            _extract_kernel(to_arrow_type(kind)),
            f"page_id {kind.simpleString()}, url string, text string, n_chars long"), "page-texts")
