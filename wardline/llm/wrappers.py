"""Main text of web pages by wrapper induction.

Every page of a host is parsed into its DOM tree, and the trees of a host's different pages are laid over
each other by the paths of their elements. Texts that ``TEMPLATE_SHARE`` of all pages hold at one path are the
host's template; the rest varies. The content slot is the innermost single element that holds the varying
text: from the root down, the child that holds four fifths of it, or half if the page marks it as article or
main. Each page is read with its host's wrapper: blocks inside the slot, without template texts, are the main
text. Inside the slot template texts go only where they are a small part of it, as pages that are near copies
agree in most of it. Menus, forms and the like that tags or ARIA roles name are left out everywhere.

A page without a slot (its host has too few pages, or another layout) is read by its own marks: the
article or main element, else the whole. Parts whose class names call them menu, advert, notice and so on
go, unless they hold half of the text.

All counts are over all different pages, in time linear in their length, and Spark groups them: a page turns
into hashes of its texts and paths, about a tenth of its size. Which texts reach the share is found in two
exact passes: one that does so among all pages does so in one of any groups the pages are dealt into, so
groups of ``GROUP`` pages name candidates, and only these are counted among all pages. The slot is found by
joins over a host's paths; no task holds a host. Extraction reads each page once and whole; elements nested
deeper than ``DEEPEST`` count as text of the element at that depth.

Defined results: null and empty html give an empty text; a null or malformed url is a host of its own
(empty); a host with fewer than ``LEAST_PAGES`` different pages has an empty template; unclosed and stray
tags are tolerated; rows that repeat are extracted each; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import per_text, ship
from wardline.session import written

# Elements without content for readers; their text is not parsed.
OPAQUE = "script|style|noscript|template|textarea|iframe|svg|object|select|title"
OPAQUE_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in OPAQUE.split("|")}
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"[>\"']")
DEEPEST = 400
LEAST_PAGES = 3
TEMPLATE_SHARE = 90  # percent of a host's different pages
SLOT_SHARE, ARTICLE_SHARE = 0.8, 0.5  # of the varying text of the element around
SMALL = 0.3  # template texts inside the slot go if they are at most this share of its text
GROUP = 256
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var".split()
)
# Roles of elements that are no content.
DROPPED_TAGS = frozenset("head nav footer aside form button menu dialog".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ad|ads|advert|adverts|advertisement|"
    r"banner|sponsor|sponsored|promo|promotion|cookie|cookies|consent|notice|notices|alert|popup|modal|overlay|newsletter|"
    r"subscribe|signup|login|form|search|comment|comments|respond|replies|disqus|share|sharing|social|related|"
    r"recommended|breadcrumb|breadcrumbs|pagination|pager|toolbar|widget|copyright|skip)(?:$|[\s_-]|\d)",
    re.I,
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr tbody ul ol dl table".split())
CLOSED_BY = {  # an open element that such a tag closes
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
        "table ul".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
}


class Node:
    __slots__ = ("label", "tag", "dropped", "named", "article", "path", "parent", "children", "text")

    def __init__(self, tag: str, label: str, parent: "Node | None", dropped: bool, named: bool, article: bool):
        self.tag, self.label, self.dropped, self.named, self.article, self.parent = tag, label, dropped, named, article, parent
        self.path = mark(parent.path, label) if parent else 0
        self.children, self.text = [], []
        if parent:
            parent.children.append(self)


def _open(tag: str, attributes: str, parent: Node) -> Node:
    given = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
    names = f"{given.get('class', '')} {given.get('id', '')}".strip()
    article = parent.article or (tag in ("article", "main") or given.get("role") in ("main", "article"))
    dropped = (
        parent.dropped or tag in DROPPED_TAGS or (tag == "header" and not parent.article)
        or given.get("role") in DROPPED_ROLES or "hidden" in given or given.get("aria-hidden") == "true"
        or "display:none" in given.get("style", "").replace(" ", "")
    )
    named = parent.named or bool(
        names and tag not in ("html", "body") and DROPPED_NAMES.search(names)
        and not (tag in ("article", "main") and not re.search(r"comment|repl", names, re.I))
    )
    return Node(tag, f"{tag}.{names}" if names else tag, parent, dropped, named, article)


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, closing, attributes) of each piece of markup; comments and the like have no tag.

    Every character is passed a bounded number of times: a ``<`` that nothing closes is text, and after
    one quote that nothing closes, tags end at the next ``>``.
    """
    last, quoted, at = page.rfind(">"), True, page.find("<")
    while at >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", False, ""
            at = page.find("<", end)
            continue
        closing = page.startswith("/", at + 1)
        name = NAME.match(page, at + 1 + closing) if at < last else None
        if name is None:
            if at < last and page[at + 1] in "!?":
                end = page.find(">", at) + 1
                yield at, end, "", False, ""
                at = page.find("<", end)
            else:
                at = page.find("<", at + 1)
            continue
        stop = TAG_STOP.search(page, name.end()) if quoted else None
        while stop and stop.group() != ">":
            pair = page.find(stop.group(), stop.end())
            stop = TAG_STOP.search(page, pair + 1) if pair >= 0 else None
        quoted = quoted and stop is not None
        end = stop.end() if stop else page.find(">", name.end()) + 1
        tag = name.group().lower()
        attributes = page[name.end() : end - 1]
        if not closing and tag in OPAQUE_END:
            close = OPAQUE_END[tag].search(page, end)
            end = close.end() if close else len(page)
        yield at, end, tag, closing, attributes
        at = page.find("<", end)


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The DOM tree, and the page's blocks: raw text with the element that holds it, in page order."""
    root = Node("", "", None, False, False, False)
    stack, blocks, held, at, beyond = [root], [], [], 0, 0

    def end_block():
        if held:
            raw = "".join(held)
            held.clear()
            if not raw.isspace():
                owner = next(n for n in reversed(stack) if n.tag not in INLINE)
                owner.text.append(raw)
                blocks.append((owner, raw))

    for start, end, tag, closing, attributes in tokens(page):
        if start > at:
            held.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br" or tag in OPAQUE_END:
            # Opaque elements end no block of their own kind, but are no part of the text.
            held.append(" ")
            continue
        block = tag not in INLINE
        if block:
            end_block()
        if closing:
            if beyond:
                beyond -= 1
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth and not (tag in INLINE and any(n.tag not in INLINE for n in stack[depth + 1 :])):
                del stack[depth:]
            continue
        if len(stack) > DEEPEST:
            beyond += tag not in VOID
            continue
        # Inline elements left open do not reach into the next block.
        while block and len(stack) > 1 and (stack[-1].tag in INLINE or tag in CLOSED_BY.get(stack[-1].tag, ())):
            stack.pop()
        node = _open(tag, attributes, stack[-1])
        if tag not in VOID and not attributes.endswith("/"):
            if node.tag in INLINE and (node.dropped, node.named) != (stack[-1].dropped, stack[-1].named):
                end_block()
            stack.append(node)
    if at < len(page):
        held.append(page[at:])
    end_block()
    return root, blocks


def clean(raw: str) -> str:
    return " ".join((entities.unescape(raw) if "&" in raw else raw).split())


def mark(path: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}") - 2**63


def _ancestors(node: Node) -> Iterator[Node]:
    while node.parent:
        yield node
        node = node.parent


def digest(page: str) -> tuple[list[tuple], list[tuple]]:
    """What a page tells about its host's wrapper.

    Its different texts (mark, path, characters; none in elements that are left out everywhere), and the
    different paths that hold text (path, paths of the elements around it from the outermost to itself,
    whether it may be a slot, is named as no content, is article, is there several times).
    """
    texts: dict[int, list] = {}
    first: dict[int, Node] = {}
    several: set[int] = set()
    article: set[int] = set()
    for owner, raw in parse(page)[1]:
        t = clean(raw)
        held = texts.setdefault(mark(owner.path, t), [owner.path, 0])
        held[1] += 0 if owner.dropped else len(t)
        for n in _ancestors(owner):
            if first.setdefault(n.path, n) is not n:
                several.add(n.path)
            if n.article:
                article.add(n.path)
    places = [
        (p, [a.path for a in _ancestors(n)][::-1], n.tag not in PARAGRAPHS and n.tag not in INLINE, n.named, p in article, p in several)
        for p, n in first.items()
    ]
    return [(m, p, n) for m, (p, n) in texts.items()], places


def induce(pages: list[str]) -> tuple[list[int], int | None]:
    """The wrapper of a host with these different pages: template marks, path of the content slot.

    What ``wrappers`` finds by joins, for pages at hand.
    """
    if len(pages) < LEAST_PAGES:
        return [], None
    told = [digest(p) for p in pages]
    seen = Counter(m for texts, _ in told for m, _, _ in texts)
    template = {m for m, n in seen.items() if 100 * n >= TEMPLATE_SHARE * len(pages)}
    constant, varying, kinds, inside = Counter(), Counter(), {}, {}
    for texts, places in told:
        for m, p, n in texts:
            (constant if m in template else varying)[p] += n
            inside.setdefault(p, set()).add(m)
        for p, above, fits, named, article, several in places:
            _, _, _, x, y = kinds.get(p, (0, 0, 0, False, False))
            kinds[p] = above, fits, named, article or x, several or y
    below = Counter()
    for p, (above, *_) in kinds.items():
        for a in above:
            below[a] += varying[p]
    slot, all_of = 0, sum(below[p] for p, k in kinds.items() if len(k[0]) == 1)
    while children := [
        (below[p], not named, p, article)
        for p, (above, fits, named, article, several) in kinds.items()
        if fits and not several and ([0] + above)[-2] == slot
    ]:
        held, _, path, article = max(children)
        if not held or held < (ARTICLE_SHARE if article else SLOT_SHARE) * all_of:
            break
        slot, all_of = path, held
    if not slot:
        return [], None
    within = [p for p, k in kinds.items() if slot in k[0]]
    kept, lost = sum(constant[p] for p in within), sum(varying[p] for p in within)
    if kept > SMALL * (kept + lost):
        template -= set().union(*(inside.get(p, set()) for p in within))
    return sorted(template), slot


def extract(page: str | None, template: frozenset | set = frozenset(), slot: int | None = None) -> str:
    """A page's main text: blocks joined by two line feeds."""
    if not page:
        return ""
    _, blocks = parse(page)
    blocks = [(n, t) for n, raw in blocks if not n.dropped and (t := clean(raw))]
    inside = [b for b in blocks if any(n.path == slot for n in _ancestors(b[0]))] if slot is not None else []
    inside = inside or [b for b in blocks if b[0].article] or blocks
    # Class names decide about parts only: what holds half of the text is content, whatever its name.
    other = [b for b in inside if not b[0].named]
    if 2 * sum(len(t) for _, t in other) > sum(len(t) for _, t in inside):
        inside = other
    return "\n\n".join(t for n, t in inside if mark(n.path, t) not in template)


def host(url) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


_TEXTS = "texts array<struct<mark: long, path: long, n: long>>"
_PLACES = "places array<struct<path: long, above: array<long>, fits: boolean, named: boolean, article: boolean, several: boolean>>"


def digests(pages: DataFrame) -> DataFrame:
    """(host, _h, texts, places): one row per host and different html, see ``digest``."""
    rows = pages.filter(F.length("html") > 0).select(
        host(F.col("url")).alias("host"), F.xxhash64("html").alias("_h"), F.col("html").alias("text")
    )
    told = per_text(rows, ["host", "_h"], f"{_TEXTS}, {_PLACES}", lambda: lambda values: zip(*map(digest, values)))
    return told.groupBy("host", "_h").agg(F.first("texts").alias("texts"), F.first("places").alias("places"))


def template_texts(told: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, mark): texts that ``TEMPLATE_SHARE`` of a host's different pages hold.

    A text with this share of all pages has it in at least one group of pages, so none is missed.
    """
    ship(told.sparkSession)
    marks = told.select("host", "_h", F.col("texts.mark").alias("marks"))
    groups = F.ceil(F.col("pages") / GROUP)
    dealt = marks.join(hosts, "host").select("host", F.pmod(F.col("_h"), groups).alias("_group"), "marks")

    def frequent(group: pd.DataFrame) -> pd.DataFrame:
        seen = Counter(m for marks in group["marks"] for m in marks)
        found = [m for m, n in seen.items() if 100 * n >= TEMPLATE_SHARE * len(group)]
        return pd.DataFrame({"host": group["host"].iloc[0], "mark": pd.Series(found, dtype="int64")})

    named = dealt.groupBy("host", "_group").applyInPandas(frequent, "host string, mark long").distinct()
    counted = marks.select("host", F.explode("marks").alias("mark")).join(written(named, "candidates"), ["host", "mark"])
    return (
        counted.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("_n")).join(hosts, "host")
        .filter(100 * F.col("_n") >= TEMPLATE_SHARE * F.col("pages")).select("host", "mark")
    )


def slots(places: DataFrame) -> DataFrame:
    """(host, slot) from ``places`` (host, path, above, fits, named, article, several, constant, varying)."""
    below = places.select("host", F.explode("above").alias("path"), "varying").groupBy("host", "path").agg(F.sum("varying").alias("below"))
    parent = F.coalesce(F.try_element_at("above", F.lit(-2)), F.lit(0).cast("long"))
    nodes = written(places.withColumn("parent", parent).join(below, ["host", "path"]).drop("constant", "varying"), "paths")
    root = nodes.filter("parent = 0").groupBy("host").agg(F.sum("below").alias("all_of")).withColumn("parent", F.lit(0).cast("long"))
    around = nodes.select("host", F.col("path").alias("parent"), F.col("below").alias("all_of")).unionByName(root)
    first = F.struct("below", (~F.col("named")).alias("unnamed"), "path", "article", "above")
    steps = (
        nodes.filter("fits and not several").groupBy("host", "parent").agg(F.max(first).alias("x")).join(around, ["host", "parent"])
        .filter((F.col("x.below") > 0) & (F.col("x.below") >= F.when(F.col("x.article"), ARTICLE_SHARE).otherwise(SLOT_SHARE) * F.col("all_of")))
        .select("host", "x.path", "x.above")
    )
    steps = written(steps, "steps")
    # The way down reaches an element if it takes every step to it.
    taken = steps.select("host", F.col("path").alias("_to"), F.explode("above").alias("path")).join(steps.select("host", "path"), ["host", "path"])
    depth = taken.groupBy("host", F.col("_to").alias("path")).agg(F.count(F.lit(1)).alias("_taken"))
    reached = steps.join(depth, ["host", "path"]).filter(F.col("_taken") == F.size("above"))
    return reached.groupBy("host").agg(F.max_by("path", "_taken").alias("slot"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, slot) of each host with a slot, from all its different pages."""
    told = written(digests(pages), "digests")
    hosts = written(told.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= LEAST_PAGES), "hosts")
    template = written(template_texts(told, hosts).withColumn("_template", F.lit(True)), "template")

    texts = told.join(hosts, "host", "left_semi").select("host", F.explode("texts").alias("t")).select("host", "t.*")
    sums = (
        texts.join(template, ["host", "mark"], "left").groupBy("host", "path").agg(
            F.sum(F.when(F.col("_template"), F.col("n")).otherwise(0)).alias("constant"),
            F.sum(F.when(F.col("_template"), 0).otherwise(F.col("n"))).alias("varying"),
            F.collect_set(F.when(F.col("_template"), F.col("mark"))).alias("marks"),
        )
    )
    kinds = (
        told.join(hosts, "host", "left_semi").select("host", F.explode("places").alias("p")).select("host", "p.*").groupBy("host", "path").agg(
            F.first("above").alias("above"), *[F.bool_or(c).alias(c) for c in ("fits", "named", "article", "several")]
        )
    )
    zero = F.lit(0).cast("long")
    laid = written(
        kinds.join(sums, ["host", "path"], "full").withColumns(
            {"constant": F.coalesce("constant", zero), "varying": F.coalesce("varying", zero), "above": F.coalesce("above", F.array().cast("array<long>"))}
        ),
        "layouts",
    )
    found = slots(laid.filter(F.size("above") > 0).drop("marks"))
    within = F.array_contains("above", F.col("slot"))
    inside = lambda c: F.sum(F.when(within, F.col(c)).otherwise(0))
    small = laid.join(found, "host").groupBy("host", "slot").agg((inside("constant") <= SMALL * (inside("constant") + inside("varying"))).alias("small"))
    small = written(small, "slots")
    marks = (
        laid.filter(F.size("marks") > 0).join(small, "host").filter(F.col("small") | ~within)
        .groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("marks"))).alias("template"))
    )
    return small.select("host", "slot").join(marks, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, slot: every page of ``pages`` (page_id, url, html) with its main text."""
    found = written(wrappers(pages), "wrappers")
    joined = pages.select("page_id", "url", F.col("html"), host(F.col("url")).alias("host")).join(found, "host", "left")
    packed = joined.select(
        "page_id", "url", "slot",
        # Slot and template marks travel with the page as text, one function argument for all.
        F.concat_ws("\0", F.coalesce(F.col("slot").cast("string"), F.lit("")), F.array_join(F.coalesce("template", F.array().cast("array<long>")).cast("array<string>"), ","), F.coalesce("html", F.lit(""))).alias("text"),
    )

    def start():
        known: dict[str, frozenset] = {}

        def one(value: str) -> str:
            slot, marks, page = value.split("\0", 2)
            if marks not in known:
                if len(known) > 10_000:
                    known.clear()
                known[marks] = frozenset(map(int, marks.split(","))) if marks else frozenset()
            return extract(page, known[marks], int(slot) if slot else None)

        return lambda values: [[one(v) for v in values]]

    return per_text(packed, ["page_id", "url", "slot"], "main_text string", start).withColumnRenamed("main_text", "text")
