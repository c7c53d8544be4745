"""Main text of web pages: drop what is not the article, and templates that recur on a site.

Pass 1 parses each page and hashes its element subtrees (tag, class, text and children).
Spark counts on how many pages of its host each subtree occurs; pages with the same text are
one page there, so copies of an article make no template. A template is on ``MANY_PAGES``
pages at least and on ``SHARE`` of its host's pages. Pass 2 takes a page together with those
of its subtrees that recur on so many pages, picks the article, deletes
menus, forms, adverts and the like as well as recurring subtrees, and returns the blocks.

Inside an article, paragraphs and headings are text of the article even where other pages
quote the same; only containers count as template there. Inline elements, headings, items
and cells go with a recurring element around them only, also where no article is marked. A subtree that holds most of the
page's text is no template either: such pages are copies.

Defined results: null or empty html gives an empty text; a null or odd url is a host of
its own name ""; repeated rows each give their row; unclosed tags, comments and attributes
end with the page. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import bound_batches
from wayfare.runtime import materialize

MANY_PAGES = 8
SHARE = 0.25
MOST_BROADCAST = 1_000_000

# Element names by their role in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg math xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_DROPPED = frozenset(
    "head nav footer aside form menu dialog button select option script style noscript template iframe textarea object embed canvas svg math audio video map".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr caption figcaption b i em strong a span code q u s small sub sup mark br".split())
# Text that may be a template by itself where no article is marked.
_PARAGRAPHS = frozenset(("p", "pre", "blockquote"))
# Names that mark other things than the article, as a class or an id or as its first or last part.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert banner newsletter subscribe subscription signup login sidebar menu navbar nav navigation "
    "breadcrumb breadcrumbs comment comments commentlist respond reply replies disqus discussion share sharing social related "
    "recommended footer popup modal overlay widget toolbar pagination pager skip search paywall".split()
)
# Inside an article these are words like any other; there only recurrence tells.
_WEAK_MARKS = frozenset("notice notices notification alert banner discussion share sharing social related recommended search header".split())
# Parts that turn a name about: layouts are called no-sidebar, has-sidebar and so on.
_TURNED = frozenset("no not non has have with without hide hides hidden show shows is are below above after before beside next".split())
# An <article> of such a name is a reader's comment, a teaser or an advert.
_NO_ARTICLE = frozenset("comment comments reply ad ads advert related teaser promo sponsored".split())
_CLOSES_P = _BLOCKS - {"body", "html"}
_SAME_LEVEL = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*+>?|(/?)([A-Za-z][^\s/>]*)([^>]*+)>?)")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Elements of a page in the order of their start, and the page as a list of events.

    An event is a text, or a number: i + 1 opens element i, -(i + 1) closes it.
    """

    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    hashes: list[int] = field(default_factory=list)
    events: list = field(default_factory=list)

    def attribute(self, i: int, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.attributes[i]):
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None


def _hash(parts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) - 2**63


def parse(source: str) -> Page:
    """Parse a page; never fails."""
    page, stack = Page(), []
    inner: list[list[str]] = [[]]  # hash parts of the open elements' contents
    tags, events, hashes = page.tags, page.events, page.hashes
    open_tags: Counter[str] = Counter()

    def close(depth: int) -> None:
        while len(stack) > depth:
            i = stack.pop()
            open_tags[tags[i]] -= 1
            own = inner.pop()
            hashes[i] = _hash([tags[i], page.attributes[i] if "class" in page.attributes[i] or "id" in page.attributes[i] else "", *own])
            inner[-1].append(str(hashes[i]))
            events.append(-(i + 1))

    def text(value: str) -> None:
        if value:
            events.append(value)
            words = " ".join(value.split())
            if words:
                inner[-1].append(words)

    at, end = 0, len(source)
    while at < end:
        start = source.find("<", at)
        if start < 0:
            text(source[at:])
            break
        m = _TAG.match(source, start)
        if not m:
            text(source[at : start + 1])
            at = start + 1
            continue
        text(source[at:start])
        at = m.end()
        if source.startswith("<!--", start):
            stop = source.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        slash, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if open_tags[tag]:
                for depth in range(len(stack) - 1, -1, -1):
                    if tags[stack[depth]] == tag:
                        close(depth)
                        break
            continue
        if tag in ("html", "body") and open_tags[tag]:
            continue
        if tag in _CLOSES_P and open_tags["p"]:
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = tags[stack[depth]]
                if open_tag == "p":
                    close(depth)
                    break
                if open_tag in _BLOCKS or open_tag in ("td", "th"):
                    break
        if tag in _SAME_LEVEL and any(open_tags[t] for t in _SAME_LEVEL[tag][0]):
            same, limits = _SAME_LEVEL[tag]
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = tags[stack[depth]]
                if open_tag in limits:
                    break
                if open_tag in same:
                    close(depth)
                    if not (tag == "tr" and open_tag != "tr"):
                        break
        i = len(tags)
        tags.append(tag)
        page.attributes.append(rest.strip())
        page.parents.append(stack[-1] if stack else -1)
        hashes.append(0)
        events.append(i + 1)
        stack.append(i)
        open_tags[tag] += 1
        inner.append([])
        if tag in _VOID or (rest.endswith("/") and tag not in _BLOCKS):
            close(len(stack) - 1)
        elif tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(source, at)
            inner[-1].append(source[at : stop.start() if stop else end])
            at = stop.start() if stop else end
    close(0)
    return page


def subtree_hashes(page: Page) -> set[int]:
    """Hashes of the subtrees that may be templates."""
    return {h for h, t in zip(page.hashes, page.tags) if t not in _VOID and t not in ("html", "body", "head", "article", "main", "title")}


def _named(page: Page, i: int, marks: frozenset) -> bool:
    """Whether a class or the id of an element is one of the marks, or begins or ends with one."""
    for name in f"{page.attribute(i, 'class') or ''} {page.attribute(i, 'id') or ''}".split():
        parts = _NAME_PARTS.findall(_CAMEL.sub(" ", name).lower())
        if parts and not _TURNED.intersection(parts) and (parts[0] in marks or parts[-1] in marks):
            return True
    return False


def _is_article(page: Page, i: int) -> bool:
    """Whether an element is, by tag or role, an article or the main part, and no reader's comment or the like."""
    kind = page.tags[i] if page.tags[i] in ("article", "main") else (page.attribute(i, "role") or "").lower() if "role" in page.attributes[i] else ""
    return kind in ("article", "main") and not _named(page, i, _NO_ARTICLE)


def _holders(page: Page, sizes: list[int]) -> list[bool]:
    """Whether an element holds an article, the main part or most of the page's text."""
    most = sum(n for n, parent in zip(sizes, page.parents) if parent < 0)
    out = [2 * n > most for n in sizes]
    for i in range(len(page.tags)):
        if _is_article(page, i):
            i = page.parents[i]
            while i >= 0 and not out[i]:
                out[i] = True
                i = page.parents[i]
    return out


def _marked(page: Page, i: int, in_article: bool, holders: list[bool]) -> bool:
    """Whether an element is by its tag, role or name no part of an article.

    Names and forms count only where they hold neither an article nor most of the text:
    pages lie in one form, and wrappers are called after the columns they make room for.
    """
    tag, attributes = page.tags[i], page.attributes[i]
    if (tag in _DROPPED and not (tag == "form" and holders[i])) or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return _named(page, i, _NO_ARTICLE)
    role = (page.attribute(i, "role") or "").lower()
    if (role in _ROLES and not (role == "form" and holders[i])) or page.attribute(i, "hidden") is not None:
        return True
    if re.search(r"display\s*:\s*none", attributes, re.IGNORECASE) or (page.attribute(i, "aria-hidden") or "").lower() == "true":
        return True
    if holders[i]:
        return False
    return _named(page, i, _MARKS - _WEAK_MARKS if in_article else _MARKS | {"header"})


def _text_sizes(page: Page) -> list[int]:
    sizes = [0] * len(page.tags)
    stack: list[int] = []
    for event in page.events:
        if isinstance(event, str):
            if stack:
                sizes[stack[-1]] += len(event)
        elif event > 0:
            stack.append(event - 1)
        else:
            i = stack.pop()
            if stack:
                sizes[stack[-1]] += sizes[i]
    return sizes


def _articles(page: Page, holders: list[bool]) -> set[int]:
    """The elements that hold the article: all <article> elements, else all main parts, that neither
    a dropped element nor another of them holds."""

    def free(i: int, chosen: set[int]) -> bool:
        i = page.parents[i]
        while i >= 0:
            if i in chosen or _marked(page, i, False, holders):
                return False
            i = page.parents[i]
        return True

    for kind in ("article", "main"):
        chosen: set[int] = set()
        for i in range(len(page.tags)):
            by_role = "role" in page.attributes[i] and page.attribute(i, "role") == kind
            if (page.tags[i] == kind or by_role) and _is_article(page, i) and free(i, chosen):
                chosen.add(i)
        if chosen:
            return chosen
    return set()


def main_text(page: Page, templates: set[int]) -> str:
    """Blocks of the article in page order, without marked elements and recurring subtrees."""
    sizes = _text_sizes(page)
    holders = _holders(page, sizes)
    roots = _articles(page, holders)
    whole = sum(sizes[i] for i in roots) if roots else max(sizes, default=0)
    blocks: list[str] = []
    parts: list[str] = []
    inside, skipped, stack_skip = not roots, 0, -1

    def flush() -> None:
        block = " ".join(html.unescape("".join(parts)).split())
        if block:
            blocks.append(block)
        parts.clear()

    for event in page.events:
        if isinstance(event, str):
            if inside and not skipped:
                parts.append(event)
            continue
        i = abs(event) - 1
        tag = page.tags[i]
        if event > 0:
            if skipped:
                continue
            if i in roots:
                inside = True
                flush()
                continue
            if not inside:
                continue
            recurring = (
                page.hashes[i] in templates
                and sizes[i] * 2 <= whole
                and not (tag in _TEXT_BLOCKS and (roots or tag not in _PARAGRAPHS))
                and tag not in ("html", "body", "article", "main")
            )
            if recurring or _marked(page, i, bool(roots), holders):
                skipped, stack_skip = 1, i
                if tag in _BLOCKS:
                    flush()
                continue
        else:
            if skipped:
                if i == stack_skip:
                    skipped = 0
                continue
            if i in roots:
                flush()
                inside = False
                continue
            if not inside:
                continue
        if tag in _BLOCKS:
            flush()
        elif tag in ("br", "td", "th", "img", "wbr") and tag != "wbr":
            parts.append(" ")
    flush()
    return "\n\n".join(blocks)


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _pair_hash(hosts, hashes: np.ndarray) -> np.ndarray:
    """One number for a host and a subtree."""
    with np.errstate(over="ignore"):
        h = (np.asarray(hosts, np.int64) * np.int64(0x5851F42D4C957F2D)) ^ hashes
        return h * np.int64(0x2545F4914F6CDD1D) ^ (h >> 31)


_PAGE = 0  # stands for the page itself among the hashes of its subtrees


def extract(pages: DataFrame, many: int = MANY_PAGES, most_broadcast: int = MOST_BROADCAST, share: float = SHARE) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Recurring subtrees are sent to all tasks while they number at most ``most_broadcast``
    (16 bytes each, counted first); more of them join the pages by shuffle. A task parses
    one page at a time.
    """
    bound_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1))
    keyed = pages.select(F.xxhash64("page_id", "url", "html").alias("_key"), "page_id", "url", "html")

    def subtrees(batches):
        for batch in batches:
            keys, hosts, bodies, hashes = [], [], [], []
            for key, name, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                page = parse(source.as_py() or "")
                own = [_PAGE, *subtree_hashes(page)]
                keys += [key] * len(own)
                hosts += [name] * len(own)
                bodies += [_hash([main_text(page, set())])] * len(own)
                hashes += own
            columns = [pa.array(c, pa.int64()) for c in (keys, hosts, bodies, hashes)]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "host", "body", "hash"])

    found = keyed.select("_key", F.xxhash64(host).alias("host"), "html").mapInArrow(subtrees, "_key long, host long, body long, hash long")
    # Pages of one text are one page here: neither repeated rows nor copies make a template.
    once = found.select("host", "body", "hash").distinct()
    counted = materialize(once.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= many))
    sizes = counted.where(F.col("hash") == _PAGE).select("host", F.col("pages").alias("of"))
    sizes = F.broadcast(sizes) if sizes.count() <= most_broadcast else sizes
    counted = counted.where(F.col("hash") != _PAGE).join(sizes, "host").where(F.col("pages") >= F.col("of") * share)
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["page_id", "url", "text", "n_chars"]
    schema = f"page_id {kind}, url string, text string, n_chars long"

    def rows(batch, templates) -> pa.RecordBatch:
        made = [main_text(page, own) for page, own in templates]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())], names=names
        )

    counted = materialize(counted.select("host", "hash"))
    if counted.count() <= most_broadcast:
        # Few enough to be sent to each task: the pages need not move.
        table = counted.toArrow()
        keys = np.sort(_pair_hash(table["host"].to_numpy(), table["hash"].to_numpy()))
        pairs = pages.sparkSession.sparkContext.broadcast(keys)
        tagged = keyed.withColumn("host", F.xxhash64(host))

        def known(batches):
            for batch in batches:
                def made(batch=batch):
                    for source, name in zip(batch.column(2), batch.column(3).to_pylist()):
                        page = parse(source.as_py() or "")
                        own = np.array(list(subtree_hashes(page)), np.int64)
                        hashed = _pair_hash(name, own)
                        at = np.minimum(np.searchsorted(pairs.value, hashed), max(len(pairs.value) - 1, 0))
                        yield page, set(own[pairs.value[at] == hashed].tolist()) if len(pairs.value) else set()

                yield rows(batch, made())

        return tagged.select("page_id", "url", "html", "host").mapInArrow(known, schema)

    recurring = found.join(counted, ["host", "hash"]).groupBy("_key").agg(F.collect_set("hash").alias("templates"))

    def joined(batches):
        for batch in batches:
            templates = batch.column(3).to_pylist()
            yield rows(batch, ((parse(h.as_py() or ""), set(t or ())) for h, t in zip(batch.column(2), templates)))

    return keyed.join(recurring, "_key", "left").select("page_id", "url", "html", "templates").mapInArrow(joined, schema)
