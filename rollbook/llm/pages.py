"""Main text of web pages by consensus of their host's pages.

1. Every page is read into blocks of text; a block belongs to the container around it, or
   to the outermost article element it stands in.  Containers of one generalised path (tags
   and classes without numbers) are a region, scored by the text that its blocks hold
   outside links.  A page votes on each of its regions: whether it is weak, with less than
   ``WEAK`` of what the page's best region holds.  Only these votes are written.
2. Votes are counted per host and path in Spark.  A path that is weak on most of its pages, and
   on ``LEAST_PAGES`` at least, is a teaser there; all others win.
3. Every page gets the teasers of its host among its own paths, is read again, and its text is that of
   all regions with winning paths, in page order.  An article split over several containers
   so stays whole, on a page of its own or with no host to ask too.

Article elements, or else main elements, that hold half of the page's text are all of it; regions of
mere links are left out beside others, and a page never loses its last region.
Nothing in an article element is left out by votes.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments are left out by element, role, and words in class or id; such words do not
count on what holds an article or main element or, without one, most paragraph text, nor
on a page that would be empty.  In an article they count on sections and paragraphs only
if they are a whole name of it, and never on headings.  A block ends where a
block-level element begins or ends; character references are decoded, white space
becomes one space, blocks are joined by newlines.

Null and empty html give the empty text; unclosed elements, comments and attributes end
where the page ends or where HTML closes them by itself.  A null url is a host of its
own.  Repeated rows vote each.  Paths have at most ``PATH`` steps, so deep nesting costs
no more than its tags; very long pages are read whole.  An empty table gives none.  Other columns are
kept whatever they are called; one named as the text is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.arrowtext import slices, texts
from rollbook.llm.storage import written

PATH = 6
SALTS = 16
#: Share of the page's best region below which a region is weak; pages that make it a teaser.
WEAK, LEAST_PAGES = 0.1, 3
#: Share of a page's text that its article or main elements hold at least if they are all of it.
MOST = 0.5

#: Tags of HTML by what they do here. Fixed values.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
CONTAINERS = frozenset("article main section div td body blockquote".split())
DROPPED = frozenset((*RAW, *"head title nav aside footer form button select menu dialog object applet".split()))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p section blockquote ul ol dl table figure".split())
ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
#: Words of class or id names that mark what is no article text. Fixed values.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice popup promo promoted related "
    "share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: An element that closes an open one of the given tags by beginning.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
#: What an implied end does not reach out of.
BARRIERS = frozenset("table ul ol dl div article section main body td blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^<>]*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Pages without such a word need no search for wrappers.
HINT = re.compile("|".join(sorted(BOILERPLATE)), re.I)


class Element:
    __slots__ = ("tag", "path", "dropped", "container", "article")

    def __init__(self, tag: str, path: tuple[str, ...], dropped: bool, article: Element | None):
        """``article``: the outermost article element around this one."""
        self.tag, self.path, self.dropped, self.article = tag, path, dropped, article
        self.container = tag in CONTAINERS and not dropped
        if tag == "article" and article is None and not dropped:
            self.article = self


#: A block: its text, its worth, its region's path, whether it stands in an article element, and in a main element.
Block = tuple[str, int, str, bool, bool]


def step(tag: str, classes: str) -> str:
    """A tag and its classes, numbers left out, in order of name."""
    names = sorted({re.sub(r"\d+", "#", c) for c in classes.split()})
    return ".".join([tag, *names[:4]])


def marked(tag: str, attributes: dict[str, str], inside: bool, words: bool = True) -> bool:
    """Whether an element holds no article text. ``inside``: an article or main element is open.

    ``words``: whether words of its class and id count.
    """
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if not words or inside and tag in HEADINGS:
        return False
    if inside and tag in PROSE:
        return any(name.lower() in BOILERPLATE for name in names.split())
    return any(word.lower() in BOILERPLATE for word in NAME.findall(names))


def wrappers(page: str) -> set[int]:
    """Where elements begin whose class or id words do not count: they hold an article or
    main element or, on pages without one, most of the text of the paragraphs."""
    found: set[int] = set()
    stack: list[list] = []  # tag, where it begins, paragraph text before it, an article in it
    total, at, paragraphs = 0, 0, 0
    sizes: list[tuple[int, int]] = []

    def close(upto: int) -> None:
        nonlocal paragraphs
        while len(stack) > upto:
            tag, start, before, article = stack.pop()
            paragraphs -= tag == "p"
            if article:
                found.add(start)
                if stack:
                    stack[-1][3] = True
            sizes.append((start, total - before))

    for m in TOKEN.finditer(page):
        if paragraphs:
            total += len(page[at : m.start()].strip())
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in INLINE or tag in VOID:
            continue
        if m["end"]:
            if (k := next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)) >= 0:
                close(k)
            continue
        if stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if tag in ("article", "main"):
            found.add(m.start())
            if stack:
                stack[-1][3] = True
        paragraphs += tag == "p"
        stack.append([tag, m.start(), total, False])
    close(0)
    if not found:
        found.update(start for start, size in sizes if 2 * size > total)
    return found


def read(page: str) -> list[Block]:
    """The blocks of text that are not left out."""
    blocks = _read(page, wrappers(page) if HINT.search(page) else set())
    # rather what its words mark than nothing
    return blocks or _read(page, None)


def _read(page: str, spared: set[int] | None) -> list[Block]:
    """``spared``: where elements begin whose words do not count; None: nowhere do they."""
    blocks: list[Block] = []
    stack: list[Element] = [Element("", (), False, None)]
    parts: list[str] = []
    link_parts = 0
    in_link = articles = mains = 0

    def flush() -> None:
        nonlocal link_parts
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                article = stack[-1].article
                holder = article or next((e for e in reversed(stack) if e.container), stack[0])
                worth = max(0, len(text) - 2 * link_parts)
                blocks.append((text, worth, "/".join(holder.path), article is not None, mains > 0))
            parts.clear()
        link_parts = 0

    def close(upto: int) -> None:
        nonlocal in_link, articles, mains
        while len(stack) > upto:
            e = stack.pop()
            in_link -= e.tag == "a"
            articles -= e.tag in ("article", "main")
            mains -= e.tag == "main"

    def find(tags: tuple[str, ...], barriers: frozenset[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                return k
            if stack[k].tag in barriers:
                break
        return 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not stack[-1].dropped:
            parts.append(page[at : m.start()])
            link_parts += (m.start() - at) * (in_link > 0)
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        block = tag not in INLINE
        if m["end"]:
            if k := find((tag,), frozenset() if block else BARRIERS):
                if block:
                    flush()
                close(k)
            elif block:
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if block:
            flush()
            if k := find(("p",), BARRIERS):
                close(k)
            if tag in CLOSES and (k := find(CLOSES[tag], BARRIERS - {tag})):
                close(k)
        if tag in VOID or m["rest"].endswith("/") and tag not in CONTAINERS:
            continue
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m["rest"])} if m["rest"].strip() else {}
        up = stack[-1]
        dropped = up.dropped or marked(tag, attributes, articles > 0, spared is not None and m.start() not in spared)
        stack.append(Element(tag, (*up.path, step(tag, attributes.get("class", "")))[-PATH:], dropped, up.article))
        in_link += tag == "a"
        articles += tag in ("article", "main")
        mains += tag == "main"
    if at < len(page) and not stack[-1].dropped:
        parts.append(page[at:])
    flush()
    return blocks


def scope(blocks: list[Block]) -> list[Block]:
    """The blocks in article elements, or else main elements, if these hold most; without regions of mere links."""
    total = sum(len(b[0]) for b in blocks)
    for within in (3, 4):
        own = [b for b in blocks if b[within]]
        if own and sum(len(b[0]) for b in own) >= MOST * total:
            blocks = own
            break
    worth = regions(blocks)
    if any(worth.values()):
        blocks = [b for b in blocks if b[3] or worth[b[2]]]
    return blocks


def regions(blocks: list[Block]) -> dict[str, int]:
    """The worth of each region's path."""
    found: dict[str, int] = {}
    for _, worth, path, *_ in blocks:
        found[path] = found.get(path, 0) + worth
    return found


def votes(page: str) -> list[tuple[str, bool]]:
    """The paths of the page's regions, and whether they are weak on it."""
    found = regions(scope(read(page)))
    best = max(found.values(), default=0)
    return [(path, worth < WEAK * best) for path, worth in found.items()]


def main_text(page: str, teasers: list[str]) -> str:
    blocks = scope(read(page))
    out = set(teasers)
    kept = [b for b in blocks if b[2] not in out]
    return "\n".join(b[0] for b in kept or blocks)


def host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def page_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, page, path, weak): the votes of each page, by MD5 of the html; repeated rows vote each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                rows = []
                for h, key, x in zip(part.column("host").to_pylist(), part.column("page").to_pylist(), texts(part, html), strict=True):
                    rows += [(h, key, path, weak) for path, weak in votes(x)]
                columns = zip(*rows, strict=True) if rows else ((), (), (), ())
                kinds = (pa.string(), pa.string(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "page", "path", "weak"])

    keyed = pages.select(host(url).alias("host"), F.md5(F.col(html).cast("binary")).alias("page"), html)
    return keyed.mapInArrow(work, "host string, page string, path string, weak boolean")


def teasers(voted: DataFrame) -> DataFrame:
    """(host, path) that are weak on most of the host's pages that have them."""
    counts = voted.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.count_if("weak").alias("weak"))
    return counts.where((F.col("weak") >= LEAST_PAGES) & (2 * F.col("weak") > F.col("pages"))).select("host", "path")


def page_teasers(voted: DataFrame) -> DataFrame:
    """(host, page, teasers): of the pages with a teaser, their paths that are one.

    Article elements may be teasers too, as whole ones.
    """
    # the salt deals a path that very many pages of a host have over several tasks
    held = voted.select("host", "page", "path").withColumn("salt", F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int"))
    marked_ = teasers(voted).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = held.join(marked_, ["host", "path", "salt"])
    return found.groupBy("host", "page").agg(F.sort_array(F.collect_set("path")).alias("teasers"))


def extract(pages: DataFrame, out: str = "main_text", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without the html, with the main text as ``out``."""
    kept = [f for f in pages.schema.fields if f.name not in (html, out)]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    names = [f"column_{k}" for k in range(len(kept))]  # whatever the columns are called
    rows = pages.select(
        *(F.col(f.name).alias(n) for f, n in zip(kept, names, strict=True)),
        F.col(html).alias("html"), host(url).alias("host"), F.md5(F.col(html).cast("binary")).alias("page"),
    )
    voted = written(page_votes(pages, url, html), "votes")
    joined = rows.join(page_teasers(voted), ["host", "page"], "left").select(*names, "html", "teasers")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [main_text(x, t or []) for x, t in zip(texts(part, "html"), part.column("teasers").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(found, pa.string())], names=schema.names)

    return joined.mapInArrow(work, schema)
