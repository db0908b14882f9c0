"""Main text of web pages with a site style tree.

Pages are parsed into trees of block elements; inline elements leave no node. The trees of a host are
merged: nodes with the same path of tags and classes are one node of the host's style tree, and a
node's own texts are a leaf below it. A leaf's importance is the entropy of its texts (a text that each
page has anew is content, one that most pages repeat is part of the site), times the share of its
characters outside links, times its mass: the share of a page's characters that its element holds, full
from ``FULL_MASS`` on; paragraphs, headings, list items and cells have that of the element they stand in.
So menus and adverts that vary from page to page fall as well. An inner node's joins the
entropy of its presentation (how its children vary over the pages) and, bottom-up, the importance of
its children, weighted by how often each presentation occurs. The trees of all hosts are merged into one more.

Names are a prior. What is in an ``article`` or ``main`` has a bonus instead of the mass, and links count
half. Names that content has as well (``header``, ``related``, ``share`` ...) halve the importance, not in an
``article`` or ``main``. Names of navigation, footers, asides, adverts, reader comments and the like leave
``NAMED`` of it, times the mass itself, times the share of pages without a content element elsewhere; within a
content element only a whole class or id is such a name. Only what HTML never shows as text (scripts,
styles, forms, hidden elements) is left out beforehand.

Verdicts are blended by number of pages, without a step: a tree of m pages weighs ``m^3 / (m^3 + h^3)``, h half
of ``min_pages``; the rest of the weight is the all-hosts tree's, and for that one the prior's (0 for
branches with a name of either kind, else 1). A node is removed from the pages if it and all nodes
below it stay under ``THRESHOLD``; content that a site repeats as a whole stays: a branch of a content
element goes only if something else in that element is important, and nothing above such an element goes.

The text is the rest: character references decoded, white space within a block turned into one
space, blocks in page order with one line end between them.

A path longer than ``LONG_PATH`` goes on from its digest, so memory grows with the number of elements however
deep they are nested. Statistics are counted per slice, then summed over the cluster; the removed paths (a few per host) go
to the tasks if there are at most ``MAX_SENT`` of them, else they are joined by host.

Defined results: null or empty html has an empty text; pages are read whole, cut ones as far as they
go; urls without a host share the empty host; repeated rows count and are returned as often as they
occur; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b, md5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.scratch import remove, written
from coursepulse.llm.words import sliced

THRESHOLD = 0.3
MIN_PAGES = 16
DECAY = 0.9
MAX_SENT = 100_000
FULL_MASS = 0.1
LONG_PATH = 400

# Fixed values of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead"}, "td": {"tr"},
                  "th": {"tr"}, "option": {"select"}}
FLOW = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
# Never text of the page.
HIDDEN_TAGS = frozenset("button datalist form head iframe noscript object optgroup option script select style svg template textarea "
                        "title".split())
# Names of presentation that is rarely content.
NOISE_TAGS = frozenset("aside dialog footer menu nav".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
CONTENT_TAGS = frozenset(("article", "main"))
_NOISE_NAME = re.compile(
    r"^(ads?|advert\w*|adsense|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|"
    r"masthead|nav|navbar|navigation|pager|pagination|popup|replies|respond|sidebar|sponsor\w*)$")
# Names that content has as well.
_WEAK_NAME = re.compile(
    r"^(banner|copyright|header|login|menu|modal|newsletter|notice|notification|promo\w*|recommended|related|search|share|sharing|"
    r"signup|social|subscribe|toolbar|widget)$")
WEAK = 0.5  # factor of the importance below a weak name
NAMED = 0.5  # factor of the importance below a name that is rarely content
BONUS = 0.2  # share of the prior in the importance of what is in an article or main
_NAME = re.compile(r"[^a-z0-9]+")
TEXT = "#text"  # the leaf that holds a node's own texts
_SEPARATORS = str.maketrans(">,~!", "____")
# What a branch is by its names: hidden, rarely content, perhaps content, in a content element, without a name.
HIDDEN, RARELY, PERHAPS, CONTENT, PLAIN = "h", "n", "w", "c", ""


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return m.group(1).rpartition("@")[2].lower() if m else ""


def _below(path: str, label: str) -> str:
    """Path of a node's child; a long path goes on from its digest."""
    return f"{path}>{label}" if len(path) <= LONG_PATH else f">{md5(path.encode('utf-8', 'replace')).hexdigest()}>{label}"


class _Node:
    __slots__ = ("tag", "path", "up", "kind", "outer", "children", "chars", "holds", "gone", "depth")

    def __init__(self, tag: str, path: str, up: "_Node | None", kind: str, gone: bool):
        self.tag, self.path, self.up, self.kind, self.gone = tag, path, up, kind, gone
        self.outer = up.outer if up else None  # the outermost content element this is in
        self.depth = up.depth + 1 if up else 0
        self.children, self.chars, self.holds = [], 0, False
        if kind == CONTENT and self.outer is None:
            self.outer = path


class PageTree(HTMLParser):
    """Blocks of a page as ``(node, text, linked characters)`` and its elements as ``(node, child signature)``.

    Branches of the paths in ``removed`` are gone; with None, those with a name of either kind are."""

    def __init__(self, elements: bool = False, removed=(), names: bool = True):
        super().__init__(convert_charrefs=True)
        self.elements = [] if elements else None
        self.removed, self.names = removed, names
        self.blocks: list[tuple[_Node, str, int]] = []
        self.stack = [_Node("", "", None, PLAIN, removed is not None and "" in removed)]
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.linked, self.link = 0, False

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                top = self.stack[-1]
                top.children.append(TEXT)
                top.chars += len(text)
                self.blocks.append((top, text, min(self.linked, len(text))))
        self.linked, self.link = 0, False

    def _pop(self) -> None:
        node = self.stack.pop()
        self.open[node.tag] -= 1
        if node.up is not None and node.kind != HIDDEN:
            node.up.chars += node.chars
            node.up.holds |= node.holds or node.outer == node.path
        if self.elements is not None:
            kinds = [c for i, c in enumerate(node.children) if not i or c != node.children[i - 1]]
            self.elements.append((node, ",".join(kinds)))
        node.children = ()

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            self.link = tag == "a" or self.link
            return
        self._flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and self.stack[-1].tag == "p":
            self._pop()
        if tag in CLOSED_BY_SAME and self.open[tag]:
            for node in reversed(self.stack):
                if node.tag in CLOSED_BY_SAME[tag]:
                    break
                if node.tag == tag:
                    while self.stack[-1] is not node:
                        self._pop()
                    self._pop()
                    break
        top = self.stack[-1]
        given = dict(attrs)
        names = sorted((given.get("class") or "").lower().split())
        label = ".".join([tag, *names]).translate(_SEPARATORS)
        kind = self._kind(top, tag, names, given)
        if kind != top.kind and kind in (RARELY, PERHAPS):  # ids and roles are no part of a path, so the mark is
            label = ("!" if kind == RARELY else "~") + label
        top.children.append(label)
        path = _below(top.path, label)
        gone = top.gone or kind == HIDDEN or (kind in (RARELY, PERHAPS) if self.removed is None else path in self.removed)
        if self.removed is None and kind == CONTENT:  # the prior of a content element counts more than a weak name above it
            gone = top.gone and top.kind != PERHAPS
        self.stack.append(_Node(tag, path, top, kind, gone))
        self.open[tag] += 1

    def _kind(self, top: _Node, tag: str, names: list[str], given: dict) -> str:
        if top.kind == HIDDEN or tag in HIDDEN_TAGS or "hidden" in given or (given.get("aria-hidden") or "").lower() == "true":
            return HIDDEN
        if top.kind == RARELY:
            return RARELY
        if not self.names:
            return CONTENT if tag in CONTENT_TAGS else top.kind
        if tag in NOISE_TAGS or (given.get("role") or "").lower() in NOISE_ROLES:
            return RARELY
        if tag in CONTENT_TAGS:
            return CONTENT
        if tag in ("html", "body"):
            return top.kind
        whole = [*names, (given.get("id") or "").lower()]
        if top.kind == CONTENT:  # parts of names as in entry-header, comment-count or nav-history mean nothing here
            return RARELY if any(_NOISE_NAME.match(x) for x in whole) else CONTENT
        words = [x for name in whole for x in _NAME.split(name) if x]
        if any(_NOISE_NAME.match(x) for x in words):
            return RARELY
        return PERHAPS if tag == "header" or any(_WEAK_NAME.match(x) for x in words) else top.kind

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in INLINE and tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in INLINE:
            self.link = self.link and tag != "a"
            return
        self._flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data):
        self.parts.append(data)
        if self.link:
            self.linked += len(data)

    def read(self, page: str) -> "PageTree":
        self.feed(page)
        self.close()
        self._flush()
        while self.stack:
            self._pop()
        return self


def page_text(page: str | None, removed=None, names: bool = True) -> str:
    """The text of a page without the branches of the paths in ``removed``; with None the names alone rule."""
    if not page:
        return ""
    blocks = PageTree(removed=removed, names=names).read(page).blocks
    return "\n".join(text for node, text, _ in blocks
                     if not node.gone and not (removed and _below(node.path, TEXT) in removed))


_COUNTS = ("host string, path string, kind string, feature string, up string, outer string, named string, depth int, "
           "pages long, holds int, rival long, mass double, links double")


def _counts(pages: DataFrame, names: bool = True) -> DataFrame:
    """In how many pages a node (kind n), a presentation (s, its children's labels) or a text (t, a digest) of a
    node occurs. Rows of kind n have the node's place in the tree and for leaves the sums over pages of
    ``mass``, ``links`` (share of linked characters) and ``rival`` (there is a content element)."""

    def run(batches):
        for b in sliced(batches, 1):
            count: Counter = Counter()
            place: dict = {}
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not page:
                    continue
                host, tree, seen = host_of(url), PageTree(elements=True, names=names).read(page), set()
                total, rival, chars, leaves = 0, 0, Counter(), {}
                for node, kinds in tree.elements:
                    if node.kind == HIDDEN:
                        continue
                    key = (host, node.path, "n", "")
                    seen.add(key)
                    seen.add((host, node.path, "s", kinds))
                    chars[node.path] += node.chars
                    total = node.chars if node.up is None else total
                    rival = rival or int(node.outer is not None)
                    row = place.get(key)
                    if row is None:
                        row = place[key] = [node.up.path if node.up else None, node.outer, node.kind, node.depth, 0, 0, 0.0, 0.0]
                    row[4] |= int(node.holds)
                for node, text, linked in tree.blocks:
                    if node.kind == HIDDEN:
                        continue
                    leaf = _below(node.path, TEXT)
                    seen.add((host, leaf, "t", blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()))
                    got = leaves.setdefault(leaf, [node, 0, 0])
                    got[1] += len(text)
                    got[2] += linked
                for leaf, (node, length, linked) in leaves.items():
                    key = (host, leaf, "n", "")
                    seen.add(key)
                    row = place.get(key)
                    if row is None:
                        row = place[key] = [node.path, node.outer, node.kind, node.depth + 1, 0, 0, 0.0, 0.0]
                    held = node
                    while held.tag in FLOW and held.up is not None:
                        held = held.up
                    row[5] += rival
                    row[6] += chars[held.path] / total if total else 0.0
                    row[7] += linked / length
                count.update(seen)
            rows = [(*k, *place.get(k, (None, None, None, None, 0, 0, 0.0, 0.0)), n) for k, n in count.items()]
            col = list(zip(*rows)) if rows else [()] * 13
            host, path, kind, feature, up, outer, named, depth, holds, rival, mass, links, n = col
            text = pa.string()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in ((host, text), (path, text), (kind, text), (feature, text), (up, text), (outer, text),
                                             (named, text), (depth, pa.int32()), (n, pa.int64()), (holds, pa.int32()),
                                             (rival, pa.int64()), (mass, pa.float64()), (links, pa.float64()))],
                names=[x.split()[0] for x in _COUNTS.split(", ")])

    return pages.mapInArrow(run, _COUNTS)


def _up_the_tree(nodes: DataFrame, rounds: int, add, join) -> DataFrame:
    """``value`` of each node joined with those of all nodes below it, in steps of doubled length."""
    before = None
    for _ in range(rounds):
        below = nodes.where("up IS NOT NULL").groupBy("host", F.col("up").alias("path")).agg(add.alias("below"))
        above = nodes.select("host", F.col("path").alias("up"), F.col("up").alias("next"), F.col("w").alias("next_w"))
        nodes = nodes.join(below, ["host", "path"], "left").join(above, ["host", "up"], "left").select(
            "host", "path", "m", "importance", F.col("next").alias("up"), (F.col("w") * F.col("next_w")).alias("w"),
            join(F.col("value"), F.col("below")).alias("value"))
        nodes, path = written(nodes, "style-tree-round")
        if before:
            remove(nodes.sparkSession, before)
        before = path
    return nodes


def _summed(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys, "path", "kind", "feature").agg(
        *[F.max(c).alias(c) for c in ("up", "outer", "named", "depth", "holds")],
        *[F.sum(c).alias(c) for c in ("pages", "rival", "mass", "links")])


def importance(counts: DataFrame) -> DataFrame:
    """``host, path, up, outer, named, holds, m, importance, highest`` of the nodes of the hosts' style trees and
    of all hosts' tree (host ``*``); ``highest`` is the greatest importance of a node and all below it.
    """
    # written, as several steps read it and pages are parsed once
    each, _ = written(_summed(counts, "host"), "style-counts")
    each = each.unionByName(_summed(each).withColumn("host", F.lit("*")))
    style, text, c = F.col("kind") == "s", F.col("kind") == "t", F.col("pages").cast("double")
    got = each.groupBy("host", "path").agg(
        *[F.max(x).alias(x) for x in ("up", "outer", "named", "depth", "holds")],
        *[F.sum(x).alias(x) for x in ("rival", "mass", "links")],
        F.max(F.when(F.col("kind") == "n", F.col("pages"))).alias("m"),
        F.sum(F.when(style, 1)).alias("styles"), F.sum(F.when(style, c)).alias("seen"),
        F.sum(F.when(style, c * F.log(c))).alias("style_logs"), F.avg(F.when(text, F.log(c))).alias("text_logs"))
    got, _ = written(got, "style-nodes")
    label = F.split("feature", ",")
    edges = each.where("kind = 's' AND feature <> ''").select("host", "path", (c / F.size(label)).alias("part"), F.explode(label).alias("label"))
    long = F.concat(F.lit(">"), F.md5(F.col("path").cast("binary")))
    edges = edges.groupBy("host", "path", "label").agg(F.sum("part").alias("part")).select(
        "host", F.concat(F.when(F.char_length("path") <= LONG_PATH, F.col("path")).otherwise(long), F.lit(">"), "label").alias("path"),
        F.col("path").alias("up"), "part")
    weight = F.pow(F.lit(DECAY), F.col("styles"))
    presentation = F.when(F.col("seen") <= 1, 1.0).otherwise((F.log("seen") - F.col("style_logs") / F.col("seen")) / F.log("seen"))
    entropy = F.when(F.col("m") <= 1, 1.0).otherwise(1 - F.col("text_logs") / F.log(F.col("m").cast("double")))
    links, mass, alone = F.col("links") / F.col("m"), F.col("mass") / F.col("m"), 1 - F.col("rival") / F.col("m")
    plain = entropy * (1 - links) * F.least(F.lit(1.0), mass / FULL_MASS)
    content = (F.when(F.col("named") == CONTENT, BONUS + (1 - BONUS) * entropy * (1 - links / 2))
               .when(F.col("named") == RARELY, NAMED * entropy * (1 - links) * mass * alone)
               .when(F.col("named") == PERHAPS, WEAK * plain).otherwise(plain))
    own = F.when(F.col("text_logs").isNotNull(), content).otherwise((1 - weight) * presentation)
    above = got.select("host", F.col("path").alias("up"), (weight / F.col("seen")).alias("share"))
    nodes = got.select("host", "path", "m", own.alias("importance"), "up").join(
        edges.select("host", "path", "part"), ["host", "path"], "left").join(above, ["host", "up"], "left").select(
        "host", "path", "m", "importance", "up", F.coalesce(F.col("part") * F.col("share"), F.lit(0.0)).alias("w"),
        F.col("importance").alias("value"))
    nodes, _ = written(nodes, "style-tree-nodes")
    deepest = got.agg(F.max("depth")).first()[0] or 0
    rounds = deepest.bit_length()
    done = _up_the_tree(nodes, rounds, F.sum(F.col("w") * F.col("value")), lambda v, b: v + F.coalesce(b, F.lit(0.0)))
    links_ = nodes.select("host", "path", "up", "w")
    full = done.select("host", "path", "m", F.col("value").alias("importance"), "value").join(links_, ["host", "path"])
    best = _up_the_tree(full, rounds, F.max("value"), F.greatest).select("host", "path", "m", "importance", F.col("value").alias("highest"))
    return best.join(got.select("host", "path", "up", "outer", "named", "holds"), ["host", "path"])


def noise(tree: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, path`` of the branches to remove, the top one of each, from the trees of :func:`importance`."""
    half = float(max(min_pages, 1)) / 2
    m = F.col("m").cast("double")
    tree = tree.withColumn("trust", F.pow(m, 3) / (F.pow(m, 3) + half ** 3))
    prior = F.when(F.col("named").isin(RARELY, PERHAPS), 0.0).otherwise(1.0)
    every = tree.where("host = '*'").select("path", (F.col("trust") * F.col("highest") + (1 - F.col("trust")) * prior).alias("all"))
    judged, _ = written(tree.where("host <> '*'").join(every, "path").select(
        "host", "path", "up", "outer", "named", "holds",
        (F.col("trust") * F.col("highest") + (1 - F.col("trust")) * F.col("all")).alias("value")), "style-judged")
    outer = judged.select("host", F.col("path").alias("outer"), F.col("value").alias("outer_value"))
    low = judged.join(outer, ["host", "outer"], "left").where(
        (F.col("value") < threshold) & (F.col("holds") == 0) &
        (F.col("outer").isNull() | (F.col("named") == RARELY) | (F.col("outer_value") >= threshold)))
    low, _ = written(low.select("host", "path", "up"), "style-noise")
    return low.join(low.select("host", F.col("path").alias("up")), ["host", "up"], "left_anti").select("host", "path")


def extract(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES, max_sent: int = MAX_SENT,
            names: bool = True) -> DataFrame:
    """One row per page: ``page_id, url, text``. Without ``names`` the trees judge with no prior but content elements."""
    src = pages.select("page_id", "url", "html")
    low, _ = written(noise(importance(_counts(src.select("url", "html"), names)), threshold, min_pages), "style-tree")
    if low.count() <= max_sent:
        by_host: dict[str, set[str]] = {}
        for r in low.collect():
            by_host.setdefault(r["host"], set()).add(r["path"])
        given = src.withColumn("removed", F.lit(None).cast("array<string>"))
    else:
        by_host = {}
        own = low.groupBy(F.col("host").alias("h")).agg(F.collect_list("path").alias("removed"))
        host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), "^.*@", ""))
        given = src.withColumn("host", host).join(own, F.col("host") == own["h"], "left").select("page_id", "url", "html", "removed")

    def run(batches):
        for b in sliced(batches, 2):
            urls, pages_, removed = (b.column(i).to_pylist() for i in (1, 2, 3))
            out = [page_text(p, by_host.get(host_of(u), frozenset()) if r is None else frozenset(r), names)
                   for u, p, r in zip(urls, pages_, removed)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    kind = src.schema["page_id"].dataType.simpleString()
    return given.mapInArrow(run, f"page_id {kind}, url string, text string")
