"""HTML main-text extraction with wrappers inferred per host.

Every page becomes a tree of block elements.  The trees of one host are folded
into one union-free wrapper: siblings of the same kind that follow each other
become one repeated group, children are aligned by longest common subsequence
and what only one side has becomes optional, and texts that differ become text
slots.  Folding wrappers is the same operation as folding pages, so each task
folds its pages, then the tasks' wrappers are folded by host in two steps (by
host and part of the tasks, then by host): all pages take part, and no task
gets all pages of a host.

The wrapper names the host's main region: its ``article`` or ``main`` element with
the most varying text, or, on hosts without one, the element reached by
following the varying text down from the body.  A page's main text is the text
of that region without menus, headers, footers, sidebars, notices, adverts,
forms, comments and invisible elements, which are known by their tag or class.
Where the region is not marked up as an article, lines that the wrapper holds
as constant go too.

Defined results: null or empty html has an empty text; a page without its
host's region uses its own; a null or odd url belongs to host ''; unclosed
elements end with their parent; elements nested deeper than ``DEPTH`` are blocks
of the element at that depth; long lists of children that differ in more than
``CELLS`` places are aligned greedily, in bounded memory; repeated rows are extracted one by one; an
empty table gives an empty result; only ``page_id, url, html`` are used.
"""

from __future__ import annotations

import bisect
import html as entities
import json
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import written
from visitflow.llm.urls import host

PARTS = 1000  # groups of tasks whose wrappers are folded first
CONSTANT_PAGES = 5  # a text is constant only if this many pages share it

# Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe svg canvas object math head title select option textarea button".split())
CHROME = frozenset("nav header footer aside form menu dialog".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary fieldset center hr".split()
) | CHROME
REGION = frozenset(("article", "main"))
CLOSED_BY_BLOCK = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
SAME_CLOSES = frozenset("li dt dd tr td th option".split())
# Parts of class, id and role names of what is not main text.
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "comment comments commentlist respond replies reply disqus discussion "
    "sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs toc pagination pager "
    "header masthead topbar footer bottombar copyright notice notices alert cookie cookies consent gdpr popup modal overlay "
    "share sharing social related recommended newsletter subscribe signup login search form skip".split()
)
# The names that also inside a main region make chrome as a part of a longer name.
STRONG_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion comment comments "
    "commentlist replies disqus cookie cookies consent gdpr popup share sharing social newsletter subscribe".split()
)
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre".split())
CELLS = 1 << 20  # of the table that aligns two lists of children
DEPTH = 200  # elements nested deeper are blocks of the element at this depth
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.S,
)
RAW = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPLIT = re.compile(r"[^a-z]+")


def kind(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """An element's name in the wrapper, and whether it is chrome.

    Chrome is hidden or chrome by its tag, or by its names: outside a main region
    by any part of them; inside one (``inside``) by a whole name, or by a part that
    names adverts, sharing or comments unless the element is a text block.  A whole
    page or region is not chrome by its layout classes.
    """
    if not attributes.strip(" /"):
        return tag, tag in CHROME or tag in HIDDEN
    whole = {w for m in NAMES.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").lower().split()}
    names = sorted({part for w in whole for part in SPLIT.split(w) if part})
    if tag in CHROME or tag in HIDDEN:
        chrome = True
    elif tag in ("html", "body", "main"):
        chrome = False
    elif inside:
        chrome = not CHROME_NAMES.isdisjoint(whole) or tag not in TEXT_TAGS and not STRONG_NAMES.isdisjoint(names)
    else:
        chrome = not CHROME_NAMES.isdisjoint(names)
    return ".".join([tag, *names]), chrome


class Element:
    __slots__ = ("name", "chrome", "children", "parent", "region", "depth", "inside", "open")

    def __init__(self, name, chrome, parent, region=False):
        self.name, self.chrome, self.parent, self.region = name, chrome, parent, region
        self.children: list[Element | str] = []
        self.depth = 0 if parent is None else parent.depth + 1
        self.inside = region or parent is not None and parent.inside  # in or under a main region
        self.open: dict[str, int] = {}  # deeper elements that count as blocks of this one


def parse(page: str) -> Element:
    """The page's tree of block elements; texts keep their place, inline tags vanish."""
    root = node = Element("", False, None)
    at = 0

    def text(a: int, b: int) -> None:
        if b > a:
            node.children.append(page[a:b])

    while m := TOKEN.search(page, at):
        text(at, m.start())
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if node.open.get(tag):
                node.open[tag] -= 1
                node.children.append(Element("hr", False, node))
                continue
            up = node
            while up is not None and up.name.partition(".")[0] != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if tag in RAW:
            at = RAW[tag].search(page, at).end()
            continue
        if tag == "br":
            node.children.append(" ")
        if tag in VOID and tag != "hr":
            continue
        name, chrome = kind(tag, m[3], node.inside)
        if tag not in BLOCK and not chrome:
            continue
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        own = node.name.partition(".")[0]
        if tag in BLOCK and own in CLOSED_BY_BLOCK or tag in SAME_CLOSES and own == tag:
            node = node.parent
        if node.depth >= DEPTH and not (chrome and not node.chrome) and tag != "hr":
            node.open[tag] = node.open.get(tag, 0) + 1
            node.children.append(Element("hr", False, node))
            continue
        child = Element(name, chrome, node, region=tag in REGION and not chrome)
        node.children.append(child)
        if tag != "hr":
            node = child
    text(at, len(page))
    unclosed = re.compile(r"<[/!?a-zA-Z][^>]*\Z")
    last = node.children[-1] if node.children else None
    if isinstance(last, str):  # a tag cut off by the end of the page
        node.children[-1] = unclosed.sub("", last)
    _spare_regions(root)
    return root


def _spare_regions(root: Element) -> None:
    """Chrome that holds a page's only main region is layout (or an element never closed), not chrome."""
    if next(_own_regions(root), None) is None:
        _spare(root)


def _spare(node: Element) -> bool:
    holds = node.region
    for c in node.children:
        if isinstance(c, Element):
            holds |= _spare(c)
    if holds and node.chrome and node.name.partition(".")[0] not in HIDDEN:
        node.chrome = False
    return holds


def blocks(node: Element, out: list[str] | None = None) -> list[str]:
    """The texts of the blocks under ``node`` in page order, without chrome."""
    out = [] if out is None else out
    run: list[str] = []

    def close() -> None:
        line = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if line:
            out.append(line)

    for c in node.children:
        if isinstance(c, str):
            run.append(c)
        elif c.name.partition(".")[0] not in BLOCK and not c.chrome:
            continue
        else:
            close()
            if not c.chrome:
                blocks(c, out)
    close()
    return out


# ---------------------------------------------------------------- wrappers
#
# A wrapper node is [name, pages, chars, text, repeated, optional, children]; text
# is the constant text of the place, or null for a slot.


def skeleton(node: Element) -> list:
    own = " ".join(entities.unescape("".join(c if isinstance(c, str) else " " for c in node.children)).split())
    children: list[list] = []
    for c in node.children:
        if isinstance(c, Element) and not c.chrome:
            new = skeleton(c)
            if children and children[-1][0] == new[0]:
                folded = fold(children[-1], new)
                folded[1] = 1
                folded[4] = True
                children[-1] = folded
            else:
                children.append(new)
    return [node.name, 1, len(own), own, False, False, children]


def fold(a: list, b: list) -> list:
    """The wrapper of both; alignment resolves mismatches into slots, repeated and optional groups."""
    children = _align(a[6], b[6])
    return [a[0], a[1] + b[1], a[2] + b[2], a[3] if a[3] == b[3] else None, a[4] or b[4], a[5] or b[5], children]


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a common subsequence: the longest, or beyond ``CELLS`` the earliest matches in turn."""
    n, m = len(a), len(b)
    start = 0
    while start < min(n, m) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(n, m) - start and a[n - 1 - end] == b[m - 1 - end]:
        end += 1
    found = [(k, k) for k in range(start)]
    x, y = a[start : n - end], b[start : m - end]
    if len(x) * len(y) > CELLS:
        places: dict[str, list[int]] = {}
        for j, name in enumerate(y):
            places.setdefault(name, []).append(j)
        after = 0
        for i, name in enumerate(x):
            of = places.get(name, [])
            k = bisect.bisect_left(of, after)
            if k < len(of):
                found.append((start + i, start + of[k]))
                after = of[k] + 1
    else:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                found.append((start + i, start + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return found + [(n - k, m - k) for k in range(end, 0, -1)]


def _align(a: list[list], b: list[list]) -> list[list]:
    out: list[list] = []

    def add(new: list) -> None:
        if out and out[-1][0] == new[0]:
            new = fold(out[-1], new)
            new[4] = True
            out[-1] = new
        else:
            out.append(new)

    pairs = _matches([x[0] for x in a], [y[0] for y in b])
    if len(pairs) == len(a) == len(b):
        return [fold(x, y) for x, y in zip(a, b)]
    i = j = 0
    for p, q in [*pairs, (len(a), len(b))]:
        for x in a[i:p] + b[j:q]:
            add([*x[:5], True, x[6]])
        if p < len(a):
            add(fold(a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def _varying(node: list) -> int:
    own = node[2] if node[3] is None or node[1] < CONSTANT_PAGES else 0
    return own + sum(map(_varying, node[6]))


def _regions(node: list, path: str):
    here = f"{path}/{node[0]}"
    if node[0].partition(".")[0] in REGION:
        yield _varying(node), here
    for c in node[6]:
        yield from _regions(c, here)


def main_region(wrapper: list) -> str:
    """Path of the main region: the marked-up region with the most varying text, else where that text lies."""
    marked = max(_regions(wrapper, ""), default=None)
    if marked:
        return marked[1]
    node, path = wrapper, "/" + wrapper[0]
    while node[6]:
        mass = [_varying(c) for c in node[6]]
        k = max(range(len(mass)), key=mass.__getitem__)
        if node[6][k][4] or mass[k] < 0.7 * _varying(node):
            break  # a repeated group of blocks, or several parts: the text of this element
        node = node[6][k]
        path += "/" + node[0]
    return path


def constants(wrapper: list) -> list[str]:
    """The texts that the wrapper holds as constant over at least ``CONSTANT_PAGES`` pages."""
    own = [wrapper[3]] if wrapper[3] and wrapper[1] >= CONSTANT_PAGES else []
    return own + [t for c in wrapper[6] for t in constants(c)]


def at_path(node: Element, path: str, here: str = "") -> list[Element]:
    here = f"{here}/{node.name}"
    if here == path:
        return [node]
    if not path.startswith(here + "/"):
        return []
    return [e for c in node.children if isinstance(c, Element) and not c.chrome for e in at_path(c, path, here)]


def extract(page: str, path: str | None, fixed: frozenset[str]) -> str:
    """The main text of a page under its host's wrapper."""
    tree = parse(page)
    found = at_path(tree, path) if path else []
    marked = bool(found) and found[0].region
    if not found or not marked and (own := list(_own_regions(tree))):
        own = list(_own_regions(tree))
        found, marked = own or [tree], bool(own)
    lines = [line for e in found for line in blocks(e)]
    return "\n".join(lines if marked else [x for x in lines if x not in fixed])


def _own_regions(node: Element):
    """The outermost marked-up regions of a page outside chrome."""
    for c in node.children:
        if isinstance(c, Element) and not c.chrome:
            if c.region:
                yield c
            else:
                yield from _own_regions(c)


# ------------------------------------------------------------------- Spark


def _task_wrappers(batches):
    held: dict[str, list] = {}
    for batch in batches:
        for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            new = skeleton(parse(page))
            held[name] = fold(held[name], new) if name in held else new
    part = TaskContext.get().partitionId() % PARTS
    if held:
        columns = [list(held), [part] * len(held), [json.dumps(w) for w in held.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], ["host", "part", "wrapper"])


def _folded(table: pa.Table) -> list:
    wrapper = None
    for text in sorted(table.column("wrapper").to_pylist()):
        new = json.loads(text)
        wrapper = new if wrapper is None else fold(wrapper, new)
    return wrapper


def _fold_part(table: pa.Table) -> pa.Table:
    return pa.table({"host": table.column("host").slice(0, 1), "wrapper": pa.array([json.dumps(_folded(table))], pa.string())})


def _fold_host(table: pa.Table) -> pa.Table:
    wrapper = _folded(table)
    path = main_region(wrapper)
    return pa.table(
        {
            "w_host": table.column("host").slice(0, 1),
            "region": pa.array([path], pa.string()),
            "fixed": pa.array([sorted(set(constants(wrapper)))], pa.list_(pa.string())),
        }
    )


def wrappers(pages: DataFrame) -> DataFrame:
    """``w_host, region, fixed`` for each host, from all its pages."""
    rows = pages.select(host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    by_task = rows.mapInArrow(_task_wrappers, "host string, part int, wrapper string")
    by_part = by_task.groupBy("host", "part").applyInArrow(_fold_part, "host string, wrapper string")
    by_host = by_part.groupBy("host").applyInArrow(_fold_host, "w_host string, region string, fixed array<string>")
    return written(by_host, "html-wrappers")


def _extractor(batches):
    for batch in batches:
        known: dict[str, frozenset] = {}
        texts = []
        for page, path, fixed, name in zip(*(batch.column(c).to_pylist() for c in ("html", "region", "fixed", "host"))):
            if name not in known:
                known[name] = frozenset(fixed or ())
            texts.append(extract(page, path, known[name]))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def html_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    found = wrappers(pages)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    rows = rows.join(found, F.col("host") == F.col("w_host"), "left").drop("w_host")
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(_extractor, f"{kinds}, text string").withColumn("n_chars", F.char_length("text").cast("long"))


def query(pages: DataFrame) -> DataFrame:
    return html_text(pages.select("page_id", "url", "html"))
