r"""Main text of web pages with a site style tree.

The DOMs of one host are merged into a tree. A node of it is a block element,
known by its path: tag, classes, id and role of every element from the root
(digits left out), and, for containers without a name, the place among equal
siblings. For every node the tree counts the distinct pages that have text
right in it (m), the pages of each different text (content) and of each
different row of children (presentation), and scores

    content      = 1 - mean over its texts of log(pages with the text) / log(m)
    presentation = entropy of its rows of children, base m
    importance   = (1 - 0.9^k) presentation + 0.9^k content   (k rows of children)

and 1 where m is 1. A node that says the same on every page scores 0, one that
says something new on each scores 1. A branch is noise when all its nodes are
below ``LEAST``; a container's text is judged by its own score and its
children's by theirs, so dropping the texts of low nodes drops those branches.
The same tree over all hosts lends a host ``BORROWED`` pages of evidence, which
settles hosts of few pages. Pages of a host that share their longest text count
as one, so copies of an article do not make it look like a menu.

Two priors need no counting: elements whose tag, role or name says what they
are (``nav``, ``role=search``, ``class=cookie-notice``) score 0, and where
``article`` or else ``main`` elements hold at least half of a page's other
text, text outside them scores 0.

Scale: pages are parsed twice and moved once, as the compressed texts of some
pages of a host. Node counts move as hashes. A host with more than 1/256 of all
pages is dealt to several tasks (at most 255 such hosts exist, so their number
of parts is a literal); its verdicts are one short list of nodes.

Text: character references are decoded, white space in a block (also no-break
space, and ``br``) is one space, blocks are trimmed and joined by one newline
in page order.

Defined results: NULL or empty html, or a page of nothing but furniture, gives
the empty text; broken or unclosed markup is read as browsers do for the common
cases (a block closes an open ``p``, ``li`` closes ``li``), an unterminated tag
at the end is dropped; a url without host puts the page with the other such
pages; very long pages are parsed whole; pages that repeat an id or a url get a
row each; an empty table gives an empty result. Only the id, url and html
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import stored

#: Importance below which a node is noise, pages that the tree of all hosts counts for, weight of presentation.
LEAST, BORROWED, DAMPING = 0.5, 8.0, 0.9
#: Text of one moved bundle of a host's pages; share of all pages beyond which a host is dealt to several tasks.
BUNDLE_BYTES, HOT_SHARE = 1 << 20, 256

# Element names of HTML and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset("""html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr
    ul caption search""".split())
COUNTED = frozenset("div section table ul ol dl td th center".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
FURNITURE_TAGS = frozenset("nav footer aside form button select dialog menu svg canvas object audio video map search head".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion banner banners
    cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login sidebar sidebars sidenav menu menus nav navbar navigation
    breadcrumb breadcrumbs pagination pager toolbar topbar footer masthead header comment comments commentlist disqus reply replies respond share
    sharing social related recommended recommendations trending widget widgets popup modal overlay""".split())
#: First parts of names that tell of the page and not of the element (``has-sidebar``).
ABOUT = frozenset("has no with without is not js".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


def named(attributes: str) -> tuple[str, set[str], str]:
    """(signature, words of class and id, role) of a start tag's attributes."""
    sign, words, role = [], set(), ""
    for m in _NAMES.finditer(attributes):
        kind, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        sign.append(kind[0] + " ".join(sorted(_DIGITS.sub("", value).split())))
        if kind == "role":
            role = value.strip().lower()
            continue
        for name in value.split():
            parts = [p.lower() for p in _PART.findall(name)]
            if parts and parts[0] not in ABOUT:
                words.update(parts)
    return "|".join(sorted(sign)), words, role


class Element:
    """An open element: its node, whether it is furniture or article, and what its children are."""

    __slots__ = ("tag", "node", "off", "mark", "children", "seen", "text")

    def __init__(self, tag: str, node: int, off: bool, mark: int):
        self.tag, self.node, self.off, self.mark = tag, node, off, mark
        self.children: list[str] = []
        self.seen: dict[str, int] = {}
        self.text = False


class Page:
    """The blocks of a page: (node, text, mark) in page order, and the rows of children of nodes that own text.

    A mark is 2 inside an ``article``, 1 inside a ``main``, else 0.
    """

    def __init__(self, html: str | None):
        self.blocks: list[tuple[int, str, int]] = []
        self.rows: list[tuple[int, int]] = []
        self.stack = [Element("", 0, False, 0)]
        self.held: list[str] = []
        self.read(html or "")

    def owner(self) -> Element:
        """The block element that text now belongs to."""
        return next(e for e in reversed(self.stack) if e.tag in BLOCK or not e.tag)

    def flush(self) -> None:
        """End the current block."""
        if self.held:
            text = _BLANK.sub(" ", "".join(self.held)).strip()
            self.held = []
            if text:
                at = self.owner()
                at.text = True
                self.blocks.append((at.node, text, at.mark))

    def pop(self) -> None:
        e = self.stack.pop()
        if e.text and e.children:
            self.rows.append((e.node, xxhash.xxh3_64_intdigest(" ".join(e.children).encode("utf-8", "replace"))))

    def close(self, tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Close the nearest open element of ``tags``, looking no further than an element of ``scope``."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    if self.stack[-1].tag in BLOCK:
                        self.flush()
                    self.pop()
                return
            if self.stack[i].tag in scope:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.held.append(" ")
            return
        block = tag in BLOCK
        if block:
            self.flush()
            if tag in CLOSES:
                self.close(CLOSES[tag], SCOPE[tag])
            if tag not in ("html", "body"):
                self.close(("p",), ("td", "th", "table", "button", "object", "caption"))
        if tag in VOID:
            return
        sign, words, role = named(attributes)
        up = self.stack[-1]
        off = up.off or tag in FURNITURE_TAGS or role in FURNITURE_ROLES or "hidden" in attributes.split()
        found = words & FURNITURE_WORDS
        if up.mark or tag in ("article", "main"):
            found -= {"header"}  # an article's header is its heading
        if tag in ("html", "body", "main"):
            found = set()
        elif tag == "article":
            found &= {"comment", "comments", "reply", "replies", "related", "sponsored", "ad", "promo"}
        off = off or bool(found) or (tag == "header" and not up.mark)
        mark = 2 if tag == "article" else max(up.mark, int(tag == "main"))
        node = up.node
        if block:
            parent = self.owner()
            full = f"{tag} {sign}"
            if not parent.children or parent.children[-1] != full:
                parent.children.append(full)
            if tag in COUNTED and not sign:
                parent.seen[tag] = parent.seen.get(tag, 0) + 1
                full = f"{full} {parent.seen[tag]}"
            node = xxhash.xxh3_64_intdigest(f"{parent.node} {full}".encode("utf-8", "replace"))
        self.stack.append(Element(tag, node, off, mark))

    def read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TOKEN.search(html, at)
            if (m.start() if m else n) > at and not self.stack[-1].off:
                self.held.append(entities.unescape(html[at:m.start() if m else n]))
            if not m:
                break
            at = m.end()
            if m.group(2):
                tag = m.group(2).lower()
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = end.end() if end else n
                else:
                    self.start(tag, m.group(3))
            elif m.group(1):
                tag = m.group(1).lower()
                if tag in BLOCK:
                    self.flush()
                self.close((tag,), () if tag in BLOCK else tuple(BLOCK))
        self.flush()
        while len(self.stack) > 1:
            self.pop()

    def main(self) -> list[tuple[int, str]]:
        """(node, text) of the blocks inside the page's article, where it marks one."""
        size = sum(len(t) for _, t, _ in self.blocks)
        for mark in (2, 1):
            inside = [(node, t) for node, t, k in self.blocks if k >= mark]
            if inside and 2 * sum(len(t) for _, t in inside) >= size:
                return inside
        return [(node, t) for node, t, _ in self.blocks]


def signed(h: int) -> int:
    """A 64-bit hash as a signed number."""
    return h - (1 << 64) if h >> 63 else h


def host_of(url: Column) -> Column:
    """Host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (site, host, html) rows in; per page its longest text's hash and its nodes' texts and rows of children.

    A count is told as two hashes, node and value; the value is 0 for the node
    itself, odd for a row of children, else even.
    """
    for batch in batches:
        same, told = [], []
        for host, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            page = Page(html)
            blocks = page.main()
            longest = max((t for _, t in blocks), key=lambda t: (len(t), t), default="")
            facts = set()
            for node, text in blocks:
                plain = _DIGITS.sub("0", text.replace(host, "@") if host else text)
                facts.add((node, 0))
                facts.add((node, xxhash.xxh3_64_intdigest(plain.encode("utf-8", "replace")) & ~1 or 2))
            facts.update((node, row | 1) for node, row in page.rows if (node, 0) in facts)
            same.append(signed(xxhash.xxh3_64_intdigest(longest.encode("utf-8", "replace"))))
            told.append(np.array(sorted(facts), "<u8").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.int64()), pa.array(told, pa.binary())], ["site", "same", "facts"])


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the facts of pages as rows site, node, value."""
    for batch in batches:
        facts = [np.frombuffer(b, "<i8").reshape(-1, 2) for b in batch.column(1).to_pylist()]
        site = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(f) for f in facts])
        both = np.concatenate(facts) if facts else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(site, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])], ["site", "node", "value"])


def importance(counts: DataFrame, *keys: str) -> DataFrame:
    """Nodes of a style tree with ``m`` and ``score`` from rows ``keys``, value, n (pages)."""
    n, value = F.col("n"), F.col("value")
    text, row = (value != 0) & (value % 2 == 0), value % 2 != 0
    sums = counts.groupBy(*keys).agg(
        F.max(F.when(value == 0, n)).alias("m"), F.avg(F.when(text, F.log(n.cast("double")))).alias("log_n"),
        F.count_if(row).alias("k"), F.sum(F.when(row, n)).alias("rows"), F.sum(F.when(row, n * F.log(n.cast("double")))).alias("n_log_n"))
    log_m = F.log(F.col("m").cast("double"))
    content = 1 - F.coalesce(F.col("log_n"), F.lit(0.0)) / log_m
    shown = F.when(F.col("k") > 0, (F.log(F.col("rows").cast("double")) - F.col("n_log_n") / F.col("rows")) / log_m).otherwise(0.0)
    weight = F.pow(F.lit(DAMPING), F.col("k"))
    return sums.select(*keys, "m", F.when(F.col("m") < 2, 1.0).otherwise((1 - weight) * shown + weight * content).alias("score"))


def noise(pages: DataFrame) -> DataFrame:
    """Nodes of low importance by site, from rows site, host, html: site, nodes."""
    told = pages.select("site", "host", "html").mapInArrow(observed, "site long, same long, facts binary")
    distinct = told.groupBy("site", "same").agg(F.min("facts").alias("facts"))
    facts = distinct.select("site", "facts").mapInArrow(spread, "site long, node long, value long")
    counts = stored(facts.groupBy("site", "node", "value").agg(F.count(F.lit(1)).alias("n")), "style-tree", "zstd")
    own = importance(counts, "site", "node")
    every = importance(counts.groupBy("node", "value").agg(F.sum("n").alias("n")), "node").select("node", F.col("score").alias("all_score"))
    # a path that most hosts have is one node of all hosts: it is spread over 32 keys
    part = F.pmod(F.xxhash64("site"), F.lit(32)).cast("int")
    every = every.withColumn("part", F.explode(F.array(*[F.lit(k) for k in range(32)])))
    both = own.withColumn("part", part).join(every, ["node", "part"])
    score = (F.col("m") * F.col("score") + BORROWED * F.col("all_score")) / (F.col("m") + BORROWED)
    return both.where(score < LEAST).groupBy("site").agg(F.sort_array(F.collect_list("node")).alias("nodes"))


def bundler(id_type: pa.DataType, limit: int) -> Callable:
    """Task function: pages in, bundles of a site's pages out: ids, urls and the compressed blocks."""

    def bundle(site: int, held: list[tuple]) -> tuple:
        nodes, sizes, texts, counts = [], [], [], []
        for _, _, blocks in held:
            counts.append(len(blocks))
            nodes += [node for node, _ in blocks]
            texts += [t.encode("utf-8", "replace") for _, t in blocks]
        sizes = [len(t) for t in texts]
        body = b"".join([np.array(counts, "<u4").tobytes(), np.array(nodes, "<u8").tobytes(), np.array(sizes, "<u4").tobytes(), *texts])
        return site, [h[0] for h in held], [h[1] for h in held], zstandard.ZstdCompressor(level=3).compress(body)

    def rows(bundles: list[tuple]) -> pa.RecordBatch:
        sites, ids, urls, bodies = zip(*bundles)
        return pa.RecordBatch.from_arrays([pa.array(sites, pa.int64()), pa.array(ids, pa.list_(id_type)), pa.array(urls, pa.list_(pa.string())), pa.array(bodies, pa.binary())],
                                          ["site", "ids", "urls", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size: dict[int, int] = {}
        total = 0
        for batch in batches:
            for site, key, url, html in zip(*(batch.column(c).to_pylist() for c in ("site", "id", "url", "html"))):
                blocks = Page(html).main()
                n = sum(len(t) for _, t in blocks) + 64
                held.setdefault(site, []).append((key, url, blocks))
                size[site] = size.get(site, 0) + n
                total += n
                if size[site] > limit:
                    total -= size.pop(site)
                    yield rows([bundle(site, held.pop(site))])
                elif total > 16 * limit:  # many sites of few pages
                    yield rows([bundle(s, h) for s, h in held.items()])
                    held, size, total = {}, {}, 0
        if held:
            yield rows([bundle(s, h) for s, h in held.items()])

    return run


def cleaner(id_type: pa.DataType) -> Callable:
    """Task function: bundles with their site's low nodes in; per page its text without them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, urls, packed, low in zip(*(batch.column(c).to_pylist() for c in ("ids", "urls", "body", "nodes"))):
                body, pages = zstandard.ZstdDecompressor().decompress(packed), len(ids)
                counts = np.frombuffer(body, "<u4", pages)
                n = int(counts.sum())
                noisy = np.isin(np.frombuffer(body, "<i8", n, 4 * pages), np.array(low or [], np.int64))
                ends = 4 * pages + 12 * n + np.cumsum(np.frombuffer(body, "<u4", n, 4 * pages + 8 * n), dtype=np.int64)
                starts = np.concatenate([[4 * pages + 12 * n], ends[:-1]]) if n else ends
                texts, dropped, at = [], [], 0
                for c in counts.tolist():
                    texts.append(b"\n".join(body[starts[i]:ends[i]] for i in range(at, at + c) if not noisy[i]).decode())
                    dropped.append(int(noisy[at:at + c].sum()))
                    at += c
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, id_type), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(counts.astype(np.int64)), pa.array(dropped, pa.int64())], ["id", "url", "text", "n_chars", "n_blocks", "n_dropped"])

    return run


def page_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row per page: id, url, text, n_chars; n_blocks (judged by the tree) and n_dropped (low in it)."""
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    pages = pages.withColumn("site", F.xxhash64("host"))
    low = noise(pages)
    sizes = pages.groupBy("site").count()
    total = pages.count()
    hot = {r.site: -(-r["count"] * HOT_SHARE // total) for r in sizes.where(F.col("count") * HOT_SHARE > total).collect()}
    parts = F.lit(1)
    for site, k in hot.items():
        parts = F.when(F.col("site") == site, k).otherwise(parts)
    id_type = pages.schema["id"].dataType
    kind, arrow = id_type.simpleString(), to_arrow_type(id_type)
    bundles = pages.select("site", "id", "url", "html").mapInArrow(bundler(arrow, bundle_bytes), f"site long, ids array<{kind}>, urls array<string>, body binary")
    bundles = bundles.withColumn("part", F.pmod(F.xxhash64("body"), parts))
    low = low.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)))
    judged = bundles.join(low.hint("merge"), ["site", "part"], "left").select("ids", "urls", "body", "nodes")
    out = judged.mapInArrow(cleaner(arrow), f"id {kind}, url string, text string, n_chars long, n_blocks long, n_dropped long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
