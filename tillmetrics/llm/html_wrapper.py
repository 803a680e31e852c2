"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes a tree of elements in which neighbours with the same label (tag, class, role) are
one repeated node. A host's wrapper is the tree that most of its different pages have (of those with
text); the trees of all its pages are aligned with it by simple tree matching, which finds the
largest number of pairs of nodes with equal labels that keeps order and ancestry. Nodes that stay
unaligned, as in pages of other layouts, meet by their paths: the labels from the root down, each
with its place among equal ones. A node whose text is the same wherever it is found is template,
one whose text varies is a slot.

Text is kept if it lies in a slot, or in a node that too few pages have, and no element
around it says that it is a menu, header, footer, sidebar, notice, advert, form, script, style
or reader comment. Classes and ids say so by whole names, those of these kinds alone, but not on html,
body, the article or, where it is the only one, what holds it. Where a page marks its article
(article, main, role=main, or a class like post-content) only that counts. An article and its copies look constant to a host that has little
else, so inside a marked article template needs WIDE different pages, and every page of the host that has
this article element must have the node and agree; outside, FEW that agree.

The first job sends a tree of labels and hashes for each page, not its text: seeds, alignment
counts and wrappers are aggregated by host, partly before the shuffle. Copies of a page count
once. The second job joins each page with its host's wrapper; the pages of a hot host are split
over tasks by adaptive execution, as the wrapper is one row. Nothing is gathered by host.

Null pages are empty; a page without content, or without words, has the text ''; pages without a
valid url share the host ''; repeated rows give repeated results; markup may be cut off
anywhere; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import shared_folder, table

FEW, WIDE = 3, 8  # different pages that must agree on a node's text
SEED, PATH = 0, 1  # how nodes meet
ARTICLE = 2  # added for the element that marks an article

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_OWN_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl menu table select article section div body main aside".split())
# What marks an element as something other than the article.
TAGS = frozenset(
    "aside button dialog footer form head iframe input menu nav noscript object script select "
    "style svg template textarea title".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
# Names of the kinds an article goes without: menus, headers, footers, sidebars and their widgets,
# notices, adverts, forms, readers' comments. All other names say nothing; the wrapper decides.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer form header menu nav navbar navigation notice "
    "notices notification pager pagination replies respond sidebar sponsor sponsored widget".split()
)
# Marks of what has articles of its own.
OTHERS = frozenset("comment comments disqus replies respond".split())

# Classes and ids that mark the article as its element would.
ARTICLES = frozenset(
    "article article-body article-content entry entry-content main-content post post-body post-content "
    "story story-body".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>'\"]++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
PART = re.compile(r"[a-z]+")


def _element(tag: str, attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """Label; whether the element, or only its names, speak against it; header or not; article or not.

    A class or id counts if all words in it are marks: cookie-notice, but not has-sidebar, which may
    as well name a layout. What other names mean is left to the wrapper.
    """
    found = {}
    for name, value in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")).lower())
    role, names = found.get("role", ""), f"{found.get('class', '')} {found.get('id', '')}".split()
    own = ARTICLES.intersection(names)
    marks_article = tag in ("article", "main") or role == "main" or bool(own)
    marks = set()
    for parts in map(PART.findall, names if tag not in ("html", "body") else ()):
        if MARKS.issuperset(parts):
            marks.update(parts)
    against = tag in TAGS or role in ROLES or bool(marks & OTHERS) or "hidden" in found
    named = bool(marks - OTHERS - {"header"}) and not marks_article
    lead = tag == "header" or "header" in marks and not marks_article
    article = not against and marks_article
    label = ".".join([tag, *sorted(set(found.get("class", "").split())), *[role] * bool(role)])
    # Neighbours that are to be told apart by other attributes don't share a label either.
    return label + "!" * (against or named) + "^" * lead, against, named, lead, article


class Memory:
    """Results of functions of strings, forgotten together when their arguments' characters are many."""

    def __init__(self, most: int = 1 << 22):
        self._most, self._size, self._held = most, 0, {}

    def of(self, function: Callable, *texts: str):
        key = (function.__name__, *texts)
        if key not in self._held:
            size = sum(map(len, texts))
            if self._size + size > self._most:
                self._held, self._size = {}, 0
            self._size += size
            self._held[key] = function(*texts)
        return self._held[key]


class Page:
    """Nodes in the order they open, by parent and label, and the page's pieces of text."""

    def __init__(self, source: str, memory: Memory | None = None):
        self._memory = memory or Memory()
        self.parents, self.labels = [-1], ["#page"]
        self.never = [False]  # by what an element is, or lies in
        self._kinds = [(False, False, False)]  # against by its names alone, header, article
        self.pieces: list[tuple[int, int, str]] = []  # block, node, text
        self._last_child: dict[int, int] = {}
        self._block = 0
        self._read(source)
        self._judge(set())
        if not any(self.inside):
            # Names don't speak against what holds the only articles.
            self._judge(self._around_articles())
        self.pieces = [p for p in self.pieces if not self.against[p[1]]]

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        label, against, *kinds = self._memory.of(_element, tag, attributes)
        last = self._last_child.get(parent)
        if last is not None and self.labels[last] == label:
            return last
        self.parents.append(parent)
        self.labels.append(label)
        self.never.append(self.never[parent] or against)
        self._kinds.append(tuple(kinds))
        self._last_child[parent] = node = len(self.labels) - 1
        return node

    def _around_articles(self) -> set[int]:
        around: set[int] = set()
        for node, (_, _, article) in enumerate(self._kinds):
            if article and not self.never[node]:
                while node >= 0 and node not in around:
                    around.add(node)
                    node = self.parents[node]
        return around

    def _judge(self, spared: set[int]) -> None:
        """Which nodes are dropped, and which lie in an article."""
        self.against, self.inside, self.article = [False], [False], [-1]
        for node in range(1, len(self.labels)):
            parent, (named, lead, article) = self.parents[node], self._kinds[node]
            inside = self.inside[parent] or article and not self.against[parent]
            named, lead = (x and node not in spared for x in (named, lead))
            self.against.append(
                self.never[node] or self.against[parent] or named or lead and not inside
            )
            self.inside.append(inside)
            self.article.append((self.article[parent] if self.inside[parent] else node) if inside else -1)

    def _say(self, node: int, text: str) -> None:
        if text and not self.never[node]:
            self.pieces.append((self._block, node, text))

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        at, size = 0, len(source)
        while at < size:
            found = TOKEN.search(source, at)
            if found is None:
                self._say(stack[-1][1], source[at:])
                return
            if found.start() > at:
                self._say(stack[-1][1], source[at : found.start()])
            at = max(found.end(), found.start() + 1)
            closing, tag = found[1] or found[4], found[2] or found[5]
            if tag is None:
                continue
            tag, attributes = tag.lower(), found[3] or found[6] or ""
            if tag == "br":
                self._say(stack[-1][1], " ")
                continue
            if tag in BLOCKS:
                self._block += 1
            if closing:
                self._close(stack, tag)
                continue
            self._close_implied(stack, tag)
            node = self._open(stack[-1][1], tag, attributes)
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                self._say(node, source[at : end.start() if end else size])
                at = end.end() if end else size
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, node))

    @staticmethod
    def _close(stack: list, tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if tag not in BLOCKS and stack[i][0] in BLOCKS:
                return  # an inline end tag doesn't reach out of its block

    @staticmethod
    def _close_implied(stack: list, tag: str) -> None:
        if tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS:
                    break
        closes = CLOSED_BY_OWN_KIND.get(tag)
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    del stack[i:]
                    if tag != "tr" or stack[-1][0] != "tr":
                        break
                elif stack[i][0] in SCOPES:
                    break

    def shape(self) -> str:
        return "\n".join(f"{p} {k}" for p, k in zip(self.parents, self.labels))

    def hashes(self) -> dict[int, int]:
        """Hash of the text that lies in each node itself."""
        own: dict[int, list[str]] = {}
        for _, node, text in self.pieces:
            own.setdefault(node, []).append(text)
        made = {n: " ".join(html.unescape(" ".join(t)).split()) for n, t in own.items()}
        return {n: xxhash.xxh64_intdigest(t) - 2**63 for n, t in made.items() if t}

    def text(self, template: set[int]) -> str:
        marked = any(self.inside[n] for _, n, _ in self.pieces)
        blocks: dict[int, list[str]] = {}
        for block, node, text in self.pieces:
            if node not in template and (self.inside[node] or not marked):
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks.values())
        return "\n".join(x for x in lines if x)


def _tree(shape: str) -> tuple[list[str], list[list[int]]]:
    labels, children = [], []
    for i, line in enumerate(shape.split("\n")):
        parent, _, label = line.partition(" ")
        labels.append(label)
        children.append([])
        if int(parent) >= 0:
            children[int(parent)].append(i)
    return labels, children


class Trees:
    """Two trees whose equal subtrees have equal kinds."""

    def __init__(self, *shapes: str):
        made = [_tree(shape) for shape in shapes]
        self.labels, self.below = [m[0] for m in made], [m[1] for m in made]
        known: dict[tuple, int] = {}
        self.sizes: list[int] = []  # nodes of a subtree, by kind
        self.kinds = [[0] * len(labels) for labels in self.labels]
        for kinds, labels, below in zip(self.kinds, self.labels, self.below):
            for node in range(len(labels) - 1, -1, -1):
                key = (labels[node], *[kinds[x] for x in below[node]])
                if key not in known:
                    known[key] = len(known)
                    self.sizes.append(1 + sum(self.sizes[kinds[x]] for x in below[node]))
                kinds[node] = known[key]

    def ends(self, a: int, b: int) -> tuple[int, int]:
        """How many children of both nodes have equal kinds in front, and how many behind those."""
        x, y = ([k[n] for n in below[node]] for k, below, node in zip(self.kinds, self.below, (a, b)))
        least, front = min(len(x), len(y)), 0
        while front < least and x[front] == y[front]:
            front += 1
        back = 0
        while back < least - front and x[-1 - back] == y[-1 - back]:
            back += 1
        return front, back

    def middles(self, a: int, b: int) -> tuple[int, list[int], list[int]]:
        """Children equal in front, and those of both nodes that are left to be matched."""
        front, back = self.ends(a, b)
        left = [below[n][front : len(below[n]) - back] for below, n in zip(self.below, (a, b))]
        return front, *left


def align(shape: str, seed: str) -> dict[int, int]:
    """Simple tree matching: nodes of the one tree paired with nodes of the other.

    Nodes are compared under paired parents only, once for each two kinds of subtrees. Equal subtrees
    at either end of two lists of children belong to a largest matching, and go without a table.
    """
    if shape == seed:
        return {i: i for i in range(shape.count("\n") + 1)}
    trees = Trees(shape, seed)
    (labels, seed_labels), (below, seed_below), (kinds, seed_kinds) = trees.labels, trees.below, trees.kinds
    narrow = np.uint16 if min(len(labels), len(seed_labels)) < 1 << 16 else np.int32
    most: dict[tuple[int, int], int] = {}  # pairs of nodes under and with two nodes, by their kinds
    tables: dict[tuple[int, int], list[np.ndarray]] = {}

    def pairs(x: int, y: int) -> int:
        kind, seed_kind = kinds[x], seed_kinds[y]
        return trees.sizes[kind] if kind == seed_kind else most[kind, seed_kind]

    def compare(a: int, b: int) -> list[tuple[int, int]]:
        """Pairs of children that have to be compared before; none: the nodes are."""
        front, left, right = trees.middles(a, b)
        own, seeds = ({k[n]: n for n in nodes} for k, nodes in ((kinds, left), (seed_kinds, right)))
        alike = [(x, y) for x in own.values() for y in seeds.values() if labels[x] == seed_labels[y]]
        first = [
            (x, y) for x, y in alike
            if kinds[x] != seed_kinds[y] and (kinds[x], seed_kinds[y]) not in most
        ]
        if first:
            return first
        place, seed_place = ({k: i for i, k in enumerate(nodes)} for nodes in (own, seeds))
        worth = np.zeros((len(own), len(seeds)), narrow)
        for x, y in alike:
            worth[place[kinds[x]], seed_place[seed_kinds[y]]] = pairs(x, y)
        across = np.array([seed_place[seed_kinds[y]] for y in right], int)
        rows = [np.zeros(len(right) + 1, narrow)]
        for x in left if right else ():
            row = np.zeros_like(rows[-1])
            both = rows[-1][:-1] + worth[place[kinds[x]]][across]
            np.maximum.accumulate(np.maximum(rows[-1][1:], both), out=row[1:])
            rows.append(row)
        same = len(below[a]) - len(left) - front
        ends = [*below[a][:front], *below[a][len(below[a]) - same :]]
        key = kinds[a], seed_kinds[b]
        most[key] = 1 + sum(trees.sizes[kinds[x]] for x in ends) + int(rows[-1][-1])
        tables[key] = rows
        return []

    waiting = [(0, 0)]
    while waiting:
        a, b = waiting[-1]
        if kinds[a] == seed_kinds[b] or (kinds[a], seed_kinds[b]) in most:
            waiting.pop()
        else:
            waiting += compare(a, b)
    paired, waiting = {}, [(0, 0)]
    while waiting:
        a, b = waiting.pop()
        paired[a] = b
        front, left, right = trees.middles(a, b)
        waiting += zip(below[a][:front], seed_below[b])
        back = len(below[a]) - front - len(left)
        if back:
            waiting += zip(below[a][-back:], seed_below[b][-back:])
        if not left or not right:
            continue
        rows, i, j = tables[kinds[a], seed_kinds[b]], len(left), len(right)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((left[i], right[j]))
    return paired


def paths(shape: str) -> list[int]:
    """For each node, the hash of its labels from the root and their places among equal siblings."""
    labels, below = _tree(shape)
    made = [xxhash.xxh64_intdigest(labels[0]) - 2**63] * len(labels)
    for node, children in enumerate(below):
        seen: dict[str, int] = {}
        for child in children:
            place = seen[labels[child]] = seen.get(labels[child], 0) + 1
            made[child] = xxhash.xxh64_intdigest(f"{made[node]} {place} {labels[child]}") - 2**63
    return made


def found_at(shape: str, seed: str, memory: Memory) -> list[tuple[int, int]]:
    """For each node, where it meets others: its partner in the seed, or else its path."""
    paired, size = memory.of(align, shape, seed), shape.count("\n") + 1
    path = memory.of(paths, shape) if len(paired) < size else []
    return [(SEED, paired[n]) if n in paired else (PATH, path[n]) for n in range(size)]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = Memory()
    for batch in batches:
        shapes, nodes, hashes, articles, pages = [], [], [], [], []
        for source in batch.column("html").to_pylist():
            page = Page(source or "", memory)
            own = page.hashes()
            shapes.append(page.shape())
            nodes.append(list(own))
            hashes.append(list(own.values()))
            articles.append(sorted({a for a in page.article if a >= 0}))
            pages.append(xxhash.xxh64_intdigest(f"{shapes[-1]} {sorted(own.items())}") - 2**63)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host"),
                pa.array(shapes, pa.string()),
                pa.array(nodes, pa.list_(pa.int32())),
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array(articles, pa.list_(pa.int32())),
                pa.array(pages, pa.int64()),
            ],
            ["host", "shape", "nodes", "hashes", "articles", "content"],
        )


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = Memory()
    for batch in batches:
        made = []
        names = ("host", "shape", "seed", "nodes", "hashes", "articles")
        columns = (batch.column(c).to_pylist() for c in names)
        for host, shape, seed, nodes, hashes, articles in zip(*columns):
            at = found_at(shape, seed, memory)
            made += [(host, *at[n], h) for n, h in zip(nodes, hashes)]
            made += [(host, at[n][0] + ARTICLE, at[n][1], 0) for n in articles]
        host, kind, node, own = zip(*made) if made else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(host, pa.string()),
                pa.array(kind, pa.int32()),
                pa.array(node, pa.int64()),
                pa.array(own, pa.int64()),
            ],
            ["host", "kind", "node", "hash"],
        )


def with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, its seed's shape, and how many different pages say the same at a node or have an article."""
    shared_folder(pages.sparkSession)
    trees = with_host(pages).select("host", "html")
    trees = trees.mapInArrow(
        _trees,
        "host string, shape string, nodes array<int>, hashes array<long>, articles array<int>, content long",
    )
    distinct = (
        trees.groupBy("host", "content")
        .agg(
            *[F.first(c).alias(c) for c in ("shape", "nodes", "hashes", "articles")],
        )
        .checkpoint()
    )
    shapes = distinct.groupBy("host", F.xxhash64("shape").alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("nodes")).alias("said"),
        F.min("shape").alias("shape"),
    )
    # A page without text has no boilerplate to find, however often it is there.
    rank = F.struct(F.col("said") > 0, "n", "said", "key")
    seeds = shapes.groupBy("host").agg(F.max_by("shape", rank).alias("seed"))
    said = distinct.join(seeds, "host").mapInArrow(
        _aligned, "host string, kind int, node long, hash long"
    )
    constant = (
        said.groupBy("host", "kind", "node")
        .agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        .filter(f"low = high and n >= if(kind < {ARTICLE}, {FEW}, {WIDE})")
    )
    listed = constant.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("kind", "node", "n"))).alias("constant")
    )
    return seeds.join(listed, "host", "left")


def _extract(kept: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("html", "seed", "constant"))
            for source, seed, constant in zip(*columns):
                page, template = Page(source or "", memory), set()
                if constant:
                    agreed = {(c["kind"], c["node"]): c["n"] for c in constant}
                    at = found_at(page.shape(), seed, memory)
                    for node, article in enumerate(page.article):
                        n = agreed.get(at[node], 0)
                        if n and article >= 0:
                            kind, place = at[article]
                            n = n >= WIDE and n == agreed.get((kind + ARTICLE, place))
                        if n:
                            template.add(node)
                texts.append(page.text(template))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [*kept, "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; pages: page_id, url, html."""
    own = pages.select("page_id", "url", "html")
    learnt = wrappers(own).withColumnRenamed("host", "host_")
    joined = with_host(own).join(learnt, F.col("host") == F.col("host_"), "left")
    return joined.select("page_id", "url", "html", "seed", "constant").mapInArrow(
        _extract(["page_id", "url"]), "page_id long, url string, text string, n_chars long"
    )


def op3_html_wrapper(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages", "page_id", "url", "html"))
