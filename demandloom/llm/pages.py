"""Main text of web pages by site style trees.

The pages of a host, copies counted once, are merged into one tree of element nodes; a node is the path of tags with
their classes, ids and roles.  For each node two things are counted over the host's pages: which
sequences of children it has, its presentation styles, and which texts, links and images it holds
itself.  With m pages that have the node, its importance is

* for a node with content of its own, 1 minus the mean over its features of log_m of the number of
  pages with that feature: what stands on every page is worth nothing,
* for one without, the entropy to the base m of its presentation styles,
* 1 if only one page has it.

A branch is removed from a page if no node in it reaches the threshold.  What names itself as a
menu, header, footer, sidebar, notice, advert, form, script, style or comment has importance 0, but
a class, id or form does not drop the main text (see `settle`).  A page that marks its main text has
nothing else.  Blocks within it are judged by their place and whole text: 1 minus log_m of the number
of distinct main texts of the host that have the text there, of m that have the block.  As distinct
main texts count, copies of an article on one host are no template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted, small_side, written
from .hosts import host_of

THRESHOLD = 0.2
#: Distinct main texts from which one text can be told to be a template.
LEAST_TEXTS = 3

# Elements of HTML by their role, and names that pages give to what is no main text.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HIDDEN = set("head script style noscript template title svg math iframe object canvas audio video".split())
NOISE_TAGS = set("nav header footer aside button select option textarea menu dialog input label".split()) | HIDDEN
NOISE_NAMES = set(
    "ad ads advert advertisement advertising adverts aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus foot footer gdpr head header masthead menu modal nav navbar navigation newsletter "
    "notice notices overlay pager pagination popup promo promotion related search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar".split())
MAIN_TAGS, MAIN_ROLES = {"article", "main"}, {"main", "article"}
PLAIN = set("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: Elements that an opening tag ends: a paragraph by any block, an item by the next one.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PARAGRAPH = {"p"}
SCOPE = set("ul ol dl table body html article main section div nav header footer aside form".split())


#: A tag that the end of the page cuts off.
UNFINISHED = re.compile(r"<[A-Za-z/!][^<>]*$")


@dataclass(slots=True)
class Node:
    tag: str
    #: Hash of the parent's key and the node's own label, so of the path.
    key: int = 0
    noise: bool = False
    named_noise: bool = False  # a noise name, or a form: noise unless it holds the main text
    main: bool = False
    named: bool = False
    at: int = 0  # place in the page's list of nodes
    up: int = -1  # place of the parent
    children: list = field(default_factory=list)  # nodes and strings, in page order
    links: list = field(default_factory=list)


def key_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


@lru_cache(100_000)
def kind_of(tag: str, classes: str, name: str, role: str) -> tuple[str, bool, bool, bool, bool]:
    """Label, noise, noise by name, main text, named: of an element by its tag and attributes."""
    names = set(re.findall(r"[a-z]+", f"{classes} {name}".lower()))
    role = role.lower()
    label = re.sub(r"\d+", "0", ".".join([tag, *sorted(classes.split()), name, role]))
    main = tag in MAIN_TAGS or role in MAIN_ROLES
    form = tag == "form" or role == "form"
    by_name = not main and (form or bool(names & NOISE_NAMES) and tag not in ("body", "html"))
    return label, tag in NOISE_TAGS or role in NOISE_ROLES, by_name, main, bool(names or role)


@lru_cache(200_000)
def key_below(above: int, label: str) -> int:
    return key_of(f"{above}/{label}")


class Page(HTMLParser):
    """The tree of a page; unclosed and misnested elements end where their container does.

    Any text is a page: what the end of the page cuts off, be it a tag, a comment or a declaration,
    is no text, and marked sections are skipped like comments.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        #: All nodes, each before what it holds.
        self.order = [self.root]
        #: Where in `open` each tag stands, and where those of SCOPE do.
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.ending = False
        self.feed(UNFINISHED.sub("", html))
        self.ending = True
        self.close()
        settle(self.order)

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        for node in reversed(self.open[at:]):
            self.places[node.tag].pop()
            if node.tag in SCOPE:
                self.scopes.pop()
        del self.open[at:]

    def _end(self, tags: set[str]) -> None:
        """End the innermost element of these tags, unless a container stands within it."""
        at = max((p[-1] for t in tags if (p := self.places.get(t))), default=0)
        if at and (not self.scopes or at >= self.scopes[-1]):
            self._cut(at)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end(PARAGRAPH)
        if tag in ENDS:
            self._end(ENDS[tag])
        if tag == "body" and self.places.get("head"):
            self._cut(self.places["head"][-1])
        given = {k: v or "" for k, v in attrs} if attrs else {}
        kind = kind_of(tag, given.get("class", ""), given.get("id", ""), given.get("role", ""))
        above = self.open[-1]
        node = Node(tag, key_below(above.key, kind[0]), *kind[1:], len(self.order), above.at)
        above.children.append(node)
        self.order.append(node)
        for key in ("href", "src"):
            if given.get(key):
                (above if tag in VOID else node).links.append(f"{key}:{given[key]}")
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and self.places.get(tag):
            self._cut(self.places[tag][-1])

    def handle_endtag(self, tag):
        places = self.places.get(tag)
        if places and (tag in SCOPE or not self.scopes or places[-1] > self.scopes[-1]):
            self._cut(places[-1])

    def handle_data(self, data):
        self.open[-1].children.append(data)

    # What follows has no end in the page where a parse gives -1.

    def _to_the_end(self, at: int) -> int:
        return len(self.rawdata) if at < 0 and self.ending else at

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):
            at = self.rawdata.find(">", i)
            return self._to_the_end(at if at < 0 else at + 1)
        return self._to_the_end(super().parse_html_declaration(i))

    def parse_comment(self, i, report=True):
        return self._to_the_end(super().parse_comment(i, report))

    def parse_pi(self, i):
        return self._to_the_end(super().parse_pi(i))

    def parse_starttag(self, i):
        return self._to_the_end(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._to_the_end(super().parse_endtag(i))

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers


def settle(order: list[Node]) -> None:
    """Make branches with a noise name noise, but not those with the main text.

    Such a branch stays if it has more than half of the text of the main element that it is in, or
    else of the page; or if it has a main element and all that the page has are in such branches.
    """
    if not any(node.named_noise for node in order):
        return
    n = len(order)
    size, mains = [0] * n, [False] * n
    for node in reversed(order):
        k = node.at
        size[k] += sum([len("".join(c.split())) for c in node.children if type(c) is str])
        mains[k] |= node.main
        if k and not node.noise:
            size[node.up] += size[k]
            mains[node.up] |= mains[k]
    of, off, outside = [size[0]] * n, [False] * n, False
    for node in order[1:]:
        k, up = node.at, node.up
        if node.named_noise and 2 * size[k] > of[up]:
            node.named_noise = False
        off[k] = off[up] or node.noise or node.named_noise
        of[k] = size[k] if node.main and of[up] == size[0] else of[up]
        outside |= node.main and not off[k]
    for node in order:
        node.noise |= node.named_noise and (outside or not mains[node.at])


def contents(order: list[Node]) -> list[int]:
    """Hash of the text of every branch, 0 where it has none; noise does not count."""
    out = [0] * len(order)
    for node in reversed(order):
        parts = []
        for c in node.children:
            part = " ".join(c.split()) if type(c) is str else "" if c.noise else str(out[c.at] or "")
            if part:
                parts.append(part)
        if parts:
            out[node.at] = key_of("|".join(parts))
    return out


def regions(order: list[Node]) -> tuple[list[bool], list[bool], bool]:
    """Which nodes are in main text, which are dropped as noise, and whether any main text is left."""
    inside, dropped, marked = [False] * len(order), [False] * len(order), False
    for node in order[1:]:
        k, up = node.at, node.up
        inside[k] = inside[up] or node.main
        dropped[k] = dropped[up] or node.noise
        marked |= inside[k] and not dropped[k]
    return inside, dropped, marked


def judged(node: Node, inside: list[bool], text: list[int]) -> bool:
    """Blocks within main text are judged by their whole text, too."""
    return inside[node.at] and not node.main and node.tag in BLOCK and text[node.at] != 0


def text_key(node: Node, text: list[int]) -> int:
    return key_of(f"{node.key}\n{text[node.at]}")


def observations(order: list[Node]) -> set[tuple[int, int, int, int | None]]:
    """(node, kind, feature, main text) of a page.

    Kind 0 is that the node is there, 1 a style, 2 a content feature; of blocks in the main text 3 is
    the whole text and 4 that there is one, with the hash of the page's main text.
    """
    seen = set()
    inside, dropped, marked = regions(order)
    text_of = contents(order) if marked else []
    whole = None
    if marked:
        outer = [n for n in order if n.main and not dropped[n.at]]
        whole = key_of("|".join(str(text_of[n.at]) for n in outer))
    for node in order:
        key = node.key
        seen.add((key, 0, 0, None))
        style = "|".join([str(c.key) for c in node.children if type(c) is not str])
        seen.add((key, 1, key_of(style), None))
        text = " ".join(" ".join([c for c in node.children if type(c) is str]).split())
        for feature in [*filter(None, [text]), *node.links]:
            seen.add((key, 2, key_of(feature), None))
        if marked and not dropped[node.at] and judged(node, inside, text_of):
            seen.add((key, 3, text_key(node, text_of), whole))
            seen.add((key, 4, 0, whole))
    return seen


def main_text(order: list[Node], low: frozenset[int] | set[int]) -> str:
    """Blocks of the page without its low branches, joined by line feeds."""
    inside, dropped, marked = regions(order)
    text_of = contents(order) if marked and low else []
    worth = [False] * len(order)
    for node in reversed(order):
        k = node.at
        worth[k] |= (inside[k] and (node.tag in PLAIN or not node.named)) or node.key not in low
        if text_of and judged(node, inside, text_of) and text_key(node, text_of) in low:
            worth[k] = False
        if k:
            worth[node.up] |= worth[k]

    blocks: list[str] = []
    run: list[str] = []

    def cut() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    todo: list = [order[0]]
    while todo:
        item = todo.pop()
        if item is None:
            cut()
        elif isinstance(item, tuple):
            if not marked or item[1]:
                run.append(item[0])
        else:
            if item.tag in BLOCK:
                cut()
            if dropped[item.at] or not worth[item.at]:
                continue
            if item.tag in BLOCK:
                todo.append(None)
            elif item.tag == "br":
                run.append(" ")
            within = inside[item.at]
            todo += [(c, within) if type(c) is str else c for c in reversed(item.children)]
    cut()
    return "\n".join(blocks)


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, node, kind, feature, weight, page = [], [], [], [], [], []
        for h, html, w in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for n, k, f, p in observations(Page(html or "").order):
                host.append(h)
                node.append(n)
                kind.append(k)
                feature.append(f)
                weight.append(w)
                page.append(p)
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int64())
        arrays = [pa.array(v, t) for v, t in zip((host, node, kind, feature, weight, page), types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "node", "kind", "feature", "weight", "page"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(Page(html or "").order, set(low or ()))
            for html, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "url", "text"])


def counted(pages: DataFrame) -> DataFrame:
    """Pages, or distinct main texts, with each observation; from host, html, weight."""
    seen = pages.mapInArrow(_observed, "host string, node long, kind int, feature long, weight double, page long")
    return seen.groupBy("host", "node", "kind", "feature").agg(
        F.when(F.col("kind") < 3, F.round(F.sum("weight"), 3)).otherwise(F.count_distinct("page")).alias("n")
    )


def low_texts(counts: DataFrame, threshold: float) -> DataFrame:
    """Texts of blocks that stand in most main texts of a host that have the block: host, node (their key)."""
    texts = counts.where(f"kind = 3 AND n >= {LEAST_TEXTS}").select("host", "node", "feature", "n")
    all_ = counts.where(f"kind = 4 AND n >= {LEAST_TEXTS}").select("host", "node", F.col("n").alias("m"))
    same_host = F.expr("a.host <=> b.host AND a.node = b.node")
    return (
        texts.alias("a").join(all_.alias("b"), same_host)
        .where(1 - F.log("n") / F.log("m") < threshold)
        .select("a.host", F.col("feature").alias("node"))
    )


def style_tree(pages: DataFrame) -> DataFrame:
    """Importance of each node of each host: host, node, m, importance; from host, html, weight."""
    return importances(counted(pages))


def importances(counts: DataFrame) -> DataFrame:
    counts = counts.where("kind < 3")
    nodes = counts.groupBy("host", "node").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("styles"),
        F.sum(F.when(F.col("kind") == 2, F.log("n"))).alias("content"),
        F.count_if(F.col("kind") == 2).alias("features"),
    )
    # Entropy of shares n / m to the base m: 1 - sum(n ln n) / (m ln m).
    base = F.log("m")
    importance = (
        F.when(F.col("m") == 1, 1.0)
        .when(F.col("features") > 0, 1 - F.col("content") / (F.col("features") * base))
        .otherwise(1 - F.col("styles") / (F.col("m") * base))
    )
    return nodes.select("host", "node", "m", importance.alias("importance"))


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of `df`: id, url, text, n_chars.

    A missing or empty page has an empty text; pages without a host share one tree.  White space in
    a block becomes one space, blocks are joined by line feeds.  Ids are only carried along,
    repeated rows stay, an empty table gives no rows, other columns are not read.
    """
    prepare(df.sparkSession)
    pages = df.select(
        quoted(id_col).alias("id"),
        quoted(url_col).alias("url"),
        quoted(html_col).cast("string").alias("html"),
        host_of(quoted(url_col).cast("string")).alias("host"),
    )
    # Copies of a page on its host count as one page.
    keyed = pages.select("host", "html", F.xxhash64("html").alias("hash"))
    copies = written(keyed.groupBy("host", "hash").agg(F.count("*").alias("of")).where("of > 1"), "copies")
    single = keyed.join(small_side(copies, copies.count()), ["host", "hash"], "left").select(
        "host", "html", (1 / F.coalesce("of", F.lit(1))).alias("weight")
    )
    # Texts of too few pages are left out early: nearly all of them.
    counts = written(counted(single).where(f"kind < 3 OR n >= {LEAST_TEXTS}"), "observed")
    low = importances(counts).where(F.col("importance") < threshold).select("host", "node")
    low = written(low.unionByName(low_texts(counts, threshold)), "low")
    by_host = low.groupBy("host").agg(F.collect_list("node").alias("low"))
    joined = pages.join(small_side(by_host, low.count(), 500_000), "host", "left").select("id", "url", "html", "low")
    kind = {c: pages.schema[c].dataType.simpleString() for c in ("id", "url")}
    texts = joined.mapInArrow(_extracted, f"id {kind['id']}, url {kind['url']}, text string")
    return texts.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars")
    )
