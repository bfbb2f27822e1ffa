"""Main text of HTML pages: site templates are found by the element subtrees that recur on a host.

Every page is parsed once to hash its block subtrees; Spark counts, per host, on how many different
pages each subtree occurs, and how many there are. A page is then parsed again without the subtrees
that enough pages and a large enough share of the pages of its host hold (``LEAST``), without what its
markup names as no content, and, if it marks its content by an ``article`` or ``main`` element, without
the rest. A list, table or box that is mostly links is a menu when a few pages share it, wherever it is;
other boxes and prose (list items and cells, too) when half of the host's pages do. The content's own
prose is not judged by recurrence: copies of an article or quoted passages are no template.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import per_row, plain, stored, text_slices

# What a row of ``subtrees`` is: a page, or a subtree of one of three kinds.
PAGE, MENU, BOX, PROSE = 0, 1, 2, 3
# On so many different pages of a host, and such a share of them, a subtree is part of the site's template.
LEAST = {MENU: (5, 0.05), BOX: (5, 0.5), PROSE: (20, 0.5)}
# A subtree with such a share of its characters in links is mostly links.
LINK_SHARE = 0.5

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is text up to their own end tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
CONTENT = frozenset(("article", "main"))
RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
ITEMS = frozenset("li dt dd thead tbody tfoot tr td th caption figure figcaption hr".split())
LISTS = frozenset("ul ol dl table".split())
DROPPED = frozenset(
    "aside audio button canvas dialog datalist fieldset footer form head iframe input label menu meter nav noembed noframes noscript object"
    " optgroup option output progress script search select style svg math template textarea title video xmp".split()
)
# Words of class, id and role names that mark no content.
NO_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments complementary"
    " consent contentinfo cookie cookies disqus footer form login masthead menu modal nav navbar navigation newsletter notice notices notification"
    " pager pagination paywall popup promo promos promotion related respond search share sharing sidebar signup social sponsor sponsored"
    " sponsors subscribe toolbar widget widgets".split()
)
# What opens an element inside one of these ends that one first.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
    "option": ("option",), "optgroup": ("option", "optgroup"),
}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BARRIERS = frozenset("ul ol dl table select menu dir html body".split())

COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
# For a tag with an odd quotation mark.
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
ROLE_MAIN = re.compile(r"""(?:^|\s)role\s*=\s*["']?main\b""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Element:
    tag: str
    dropped: bool
    content: bool
    inline: bool
    first: int
    # Characters of the page before it, and those in links.
    before: tuple[int, int] = (0, 0)
    parts: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Blocks of text in page order, whether each is content, and the subtrees over them."""

    texts: list[str] = field(default_factory=list)
    content: list[bool] = field(default_factory=list)
    dropped: list[bool] = field(default_factory=list)
    # Hash, first block, end and kind of the subtrees that recurrence may delete.
    subtrees: list[tuple[int, int, int, int]] = field(default_factory=list)
    has_content: bool = False

    def main_text(self, recurring: frozenset[int] | set[int] = frozenset()) -> str:
        """The blocks that are left, joined by empty lines."""
        keep = [not d and (c or not self.has_content) for d, c in zip(self.dropped, self.content, strict=True)]
        for h, first, end, _ in self.subtrees:
            if h in recurring:
                keep[first:end] = [False] * (end - first)
        return "\n\n".join(t for t, k in zip(self.texts, keep, strict=True) if k)


def parse(source: str) -> Page:
    """Parse a page, however broken: unknown end tags are ignored, open elements end with the page."""
    page = Page()
    stack = [Element("", False, False, False, 0)]
    # How many elements of each tag are open, and of each kind.
    opened: Counter[str] = Counter()
    buffer: list[str] = []
    # Characters so far and those in links; how many elements are open where the open link began, 0 without one.
    chars = linked = link = 0

    def add(text: str) -> None:
        nonlocal chars, linked
        buffer.append(text)
        n = len(text.strip())
        chars += n
        linked += n if link else 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        buffer.clear()
        if text:
            page.texts.append(text)
            page.content.append(opened["(content)"] > 0)
            header = opened["header"] > 0 and not any(opened[h] for h in HEADINGS)
            page.dropped.append(header or opened["(dropped)"] > 0)
            stack[-1].parts.append(text)

    def kinds(element: Element) -> list[str]:
        return [element.tag, *["(content)"] * element.content, *["(dropped)"] * element.dropped]

    def kind(element: Element) -> int | None:
        """Of a closed element; None if recurrence can't delete it."""
        inside = opened["(content)"] > 0 or element.content
        prose = element.tag in RUNNING or element.tag in ITEMS
        n, links = chars - element.before[0], linked - element.before[1]
        if len(page.texts) == element.first or element.content:
            return None
        if not prose and links >= LINK_SHARE * n and links:
            return MENU
        if prose or element.tag in LISTS:
            return None if inside else PROSE
        return BOX

    def close() -> None:
        nonlocal link
        element = stack[-1]
        if not element.inline:
            flush()
        stack.pop()
        opened.subtract(kinds(element))
        if element.inline:
            return
        if len(stack) < link:
            link = 0
        name = xxhash.xxh3_64_hexdigest("\0".join([element.tag, *element.parts]).encode("utf-8", "surrogatepass"))
        stack[-1].parts.append(f"<{name}>")
        if (found := kind(element)) is not None:
            page.subtrees.append((int(name, 16) - (1 << 63), element.first, len(page.texts), found))

    at, end, strict = 0, len(source), True
    while at < end:
        open_at = source.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at and not stack[-1].inline:
            add(source[at:open_at])
        if open_at == end:
            break
        found = TAG.match(source, open_at) if strict else None
        if not found:
            if other := COMMENT.match(source, open_at):
                at = other.end()
                continue
            found = LOOSE_TAG.match(source, open_at)
            if not found:
                if re.match(r"</?[a-zA-Z]", source[open_at : open_at + 3]):
                    break  # The page ends within a tag.
                if not stack[-1].inline:
                    add("<")
                at = open_at + 1
                continue
            strict = False
        at = found.end()
        tag, attributes = found[2].lower(), found[3]
        if tag == "a":
            link = 0 if found[1] else len(stack)
            continue
        if found[1]:
            if tag == "br":
                buffer.append(" ")
            elif opened[tag]:
                while stack[-1].tag != tag:
                    close()
                close()
            elif tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            if opened["p"]:
                while stack[-1].tag != "p":
                    close()
                close()
            for depth in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ENDS.get(tag, ())) else ():
                if stack[depth].tag in ENDS[tag]:
                    while len(stack) > depth:
                        close()
                elif stack[depth].tag in BARRIERS:
                    break
        if tag in RAW:
            closing = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(source, at)
            at = closing.end() if closing else end
            continue
        if tag == "br":
            buffer.append(" ")
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in DROPPED:
            if tag in BLOCKS:
                flush()
            continue
        if tag not in BLOCKS and tag not in DROPPED:
            continue
        inline = tag not in BLOCKS
        if not inline:
            flush()
        names = {w for a, b, c in NAMES.findall(attributes) for w in WORD.findall((a or b or c).lower())} if attributes else set()
        content = tag in CONTENT or bool(attributes and ROLE_MAIN.search(attributes))
        top = tag in ("html", "body")
        dropped = not top and not content and (tag in DROPPED or bool(names & NO_CONTENT) or bool(attributes and HIDDEN.search(attributes)))
        page.has_content |= content and not opened["(dropped)"]
        stack.append(Element(tag, dropped, content, inline, len(page.texts), (chars, linked)))
        opened.update(kinds(stack[-1]))
    while len(stack) > 1:
        close()
    flush()
    return page


def subtrees(pages: DataFrame) -> DataFrame:
    """``(key, other, host, body, hash, kind)``: the subtrees of every page, one row for the page itself, and a hash of all its text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in text_slices(frames, "html"):
            rows = []
            for key, other, host, source in zip(part["key"], part["other"], part["host"], part["html"], strict=True):
                page = parse(source)
                body = xxhash.xxh3_64_intdigest("\0".join(page.texts).encode("utf-8", "surrogatepass")) - (1 << 63)
                rows.append((key, other, host, body, 0, PAGE))
                rows.extend((key, other, host, body, h, kind) for h, kind in {(h, kind) for h, _, _, kind in page.subtrees})
            yield pd.DataFrame(rows, columns=["key", "other", "host", "body", "hash", "kind"])

    return pages.mapInPandas(run, "key long, other long, host string, body long, hash long, kind int")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every row: its main text and that text's number of code points.

    Null and empty pages have an empty text. A page without a host in its url belongs to the host ''.
    Pages of one host with the same text count once; hosts of fewer such pages than ``LEAST`` asks for show no
    template. Repeated rows each get their row. Pages are told apart by 128 bits. Other columns don't matter.
    """
    host = F.lower(F.regexp_extract(F.coalesce(plain(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = [plain(key), plain(url), plain(source)]
    rows = pages.select(
        F.xxhash64(*own).alias("key"), F.xxhash64(F.lit("other"), *own).alias("other"), host.alias("host"), plain(key).alias("page"),
        plain(url).alias("url"), plain(source).alias("html"),
    )
    found = stored(subtrees(rows.select("key", "other", "host", "html")), "subtrees")
    counts = stored(found.select("host", "kind", "hash", "body").distinct().groupBy("host", "kind", "hash").agg(F.count(F.lit(1)).alias("n")), "counts")
    sizes = counts.filter(F.col("kind") == PAGE).select("host", F.col("n").alias("pages"))
    often = F.lit(False)
    for kind, (least, share) in LEAST.items():
        often = often | (F.col("kind") == kind) & (F.col("n") >= least) & (F.col("n") >= F.col("pages") * share)
    recurring = counts.filter((F.col("kind") != PAGE) & (F.col("n") >= min(n for n, _ in LEAST.values()))).join(sizes, "host").filter(often)
    # At most the subtrees of one page meet in a row.
    templates = (
        found.filter(F.col("kind") != PAGE).join(stored(recurring.select("host", "kind", "hash"), "recurring"), ["host", "kind", "hash"])
        .groupBy(F.col("key").alias("of"), F.col("other").alias("of_other")).agg(F.collect_set("hash").alias("recurring"))
    )
    both = rows.drop("host").join(templates, (F.col("key") == F.col("of")) & (F.col("other") == F.col("of_other")), "left")

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda part: pd.DataFrame({"text": [
            parse(page).main_text(set() if recurring is None else set(recurring.tolist()))
            for page, recurring in zip(part["html"], part["recurring"], strict=True)
        ]})

    text = per_row({"html": F.col("html"), "recurring": F.col("recurring")}, setup, "text string", "html")["text"]
    out = both.select("page", "url", text.alias("text"))
    return out.select(F.col("page").alias(key), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
