"""Main text of web pages by differencing pages of neighbouring URLs.

1. A page becomes text lines: blocks and line breaks end a line, references are decoded, white space
   becomes one space. A line knows where it stands: in a menu, footer, form or the like (*furniture*,
   told by element, role, class or id), in an article or main element, in a text block (paragraph,
   heading, list item, cell, quotation) or loose.
2. Pages stand in one order by (host, path); each is paired with its nearest neighbours in that
   order, on its host. Only hosts, paths and 64-bit line codes are moved, dealt by ranges of that
   order, so a host with a third of all pages is spread like any other.
3. A pair's lines are aligned by a longest common subsequence. Lines shared with every neighbour that
   is not a copy in all its lines are template and deleted.
4. What differencing must not take for template is checked: on a page with an article (else a main)
   element, its text blocks stay even if neighbours share them (licence lines, quotations, copies),
   and what stands outside is no article. Furniture never is, shared or not: menus and adverts that
   change with each page are out of a difference's reach.

Of several longest alignments the one that takes the page's earliest lines counts. Memory for an
alignment of n and m lines is about n ** 0.5 * m bits. Only pages that lose lines are written for the
last join; each page is parsed again there, so no text is shuffled while that table is small.

Defined results: null or empty html has no text, a null url or one without ``://`` belongs to the
empty host; rows equal in id, url and html get the same text; repeated ids are pages of their own.
Very long pages are parsed whole. An unclosed script, style or comment runs to the page's end. An
empty table gives no rows. Only the id, url and html columns are read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import partitions, slices, stored, text_of

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(
    r"""([a-zA-Z][^\s=/>"']*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; what is in them is not parsed.
RAW = frozenset("script style title textarea noscript template svg math iframe object canvas "
                "audio video select xmp".split())
FURNITURE = frozenset("nav footer aside form menu dialog button".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption "
                        "figcaption".split())
CONTAINERS = frozenset("html head body div section article main header ul ol dl table thead tbody "
                       "tfoot tr figure fieldset details summary address hgroup center".split()
                       ) | FURNITURE
BLOCKS = TEXT_BLOCKS | CONTAINERS | {"hr", "br", "legend", "optgroup", "option"}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog "
                  "alertdialog alert toolbar".split())
#: Words of classes and ids that name furniture, whatever element has them.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr "
    "notice notices newsletter subscribe subscription signup login social share sharing related "
    "recommended recommendations popup modal overlay widget pagination pager skip toolbar "
    "copyright masthead topbar".split())
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
WORD = re.compile(r"[a-z]+")

# How far an element is furniture: not, by its class only, by what it is.
NONE, NAMED, SURE = 0, 1, 2
# Where a line stands.
GONE, BODY, MAIN, ARTICLE = 0, 1, 2, 3


def standing(tag: str, attributes: str, inside: tuple[int, int]) -> tuple[int, int]:
    """(furniture, place) of an element inside one with ``inside``."""
    skip, place = inside
    held = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(
        attributes)} if attributes.strip() else {}
    words = set(WORD.findall(f"{held.get('class', '')} {held.get('id', '')}"))
    role = held.get("role", "")
    if (tag in FURNITURE or role in ROLES or words & COMMENT_WORDS or "hidden" in held
            or held.get("aria-hidden") == "true" or tag == "head"
            or (tag == "header" and place < MAIN) or "display:none" in held.get(
                "style", "").replace(" ", "")):
        return SURE, place
    if tag == "article" or "articlebody" in held.get("itemprop", ""):
        return (skip if skip == SURE else NONE), ARTICLE
    if tag == "main" or role == "main":
        return (skip if skip == SURE else NONE), max(place, MAIN)
    if tag not in ("html", "body") and words & FURNITURE_WORDS:
        return max(skip, NAMED), place
    return skip, place


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, place, whether in a text block) of the page's lines in order."""
    out: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, int, int]] = [("", NONE, BODY)]
    held: list[str] = []
    block = ""

    def ended() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            _, skip, place = stack[-1]
            out.append((text, GONE if skip else place, block in TEXT_BLOCKS))

    at = 0
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            begin = len(page)
        if begin > at:
            held.append(references.unescape(page[at:begin]))
        token = TOKEN.match(page, begin)
        if not token:
            if begin < len(page):
                held.append("<")
            at = begin + 1
            continue
        at = token.end()
        closing, tag = token[1] or token[4], (token[2] or token[5] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag not in BLOCKS:
            continue
        ended()
        if tag in ("br", "hr"):
            continue
        if closing:
            block = ""
            if tag in CONTAINERS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
        else:
            block = tag
            attributes = token[3] or token[6] or ""
            if tag in CONTAINERS and tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, *standing(tag, attributes, stack[-1][1:])))
    ended()
    return out


def candidates(lines: list[tuple[str, int, bool]]) -> list[int]:
    """0: not the main text. 1: main text unless neighbours share it. 2: main text."""
    top = max((place for _, place, _ in lines), default=GONE)
    return [0 if place < max(top, BODY) else 2 if top > BODY and block else 1
            for _, place, block in lines]


# --- alignment ------------------------------------------------------------------------


def shared(own: list[int], other: list[int]) -> list[int]:
    """Indexes of ``own`` in a longest common subsequence with ``other``, the earliest of all.

    Row i holds, as bits of a whole number, where the best length of own[i:] and other[j:] grows
    as j falls; every ``step``-th row is kept and the others are computed again on the way back.
    """
    n, m = len(own), len(other)
    places: dict[int, list[int]] = {}
    masks: dict[int, int] = {}
    for j, code in enumerate(other):
        places.setdefault(code, []).append(j)
        masks[code] = masks.get(code, 0) | 1 << (m - 1 - j)
    full, step = (1 << m) - 1, max(1, int(n ** 0.5))

    def above(row: int, code: int) -> int:
        rest = row ^ full  # bits that have not grown yet
        hit = rest & masks.get(code, 0)
        return full ^ ((rest + hit | rest ^ hit) & full)

    kept, row = {n: 0}, 0
    for i in range(n - 1, -1, -1):
        row = above(row, own[i])
        if i % step == 0:
            kept[i] = row
    found, j, block = [], 0, {}
    for i in range(n):
        if i % step == 0:
            last = min(n, i + step)
            block = {last: kept[last]}
            for k in range(last - 1, i - 1, -1):
                block[k] = above(block[k + 1], own[k])
        length = (block[i] & (1 << (m - j)) - 1).bit_count()
        if not length:
            break
        later = places.get(own[i], [])
        at = np.searchsorted(later, j)
        if at < len(later):
            after = later[at] + 1
            if 1 + (block[i + 1] & (1 << (m - after)) - 1).bit_count() == length:
                found.append(i)
                j = after
    return found


def template(own: list[int], neighbours: list[list[int]]) -> set[int]:
    """Indexes of lines that every neighbour shares, leaving out copies."""
    sets = [set(shared(own, other)) for other in neighbours if other != own]
    return set.intersection(*sets) if sets else set()


# --- the operator ---------------------------------------------------------------------


def located(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, url, html, host, path and a 128-bit key of the row."""
    rest = F.regexp_extract(text_of(url), r"(?s)^.*?://(.*)$", 1)
    return pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
        F.lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1).alias("path"),
        F.xxhash64(page_id, url, html).alias("k1"),
        F.xxhash64(F.lit(1), html, url, page_id).alias("k2"))


def coded(pages: DataFrame) -> DataFrame:
    """host, path, key, the codes of a page's lines and which of them are candidates."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes, kinds = [], []
            for value in batch["html"]:
                lines = lines_of(value.as_py() or "")
                codes.append([xxhash.xxh3_64_intdigest(text) - (1 << 63) for text, _, _ in lines])
                kinds.append(candidates(lines))
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in ("host", "path", "k1", "k2")),
                 pa.array(codes, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int8()))],
                names=["host", "path", "k1", "k2", "codes", "kinds"])

    return pages.select("host", "path", "k1", "k2", "html").mapInArrow(
        code, "host string, path string, k1 bigint, k2 bigint, codes array<bigint>, "
              "kinds array<tinyint>")


def neighboured(lined: DataFrame) -> DataFrame:
    """Each page with the codes of the pages before and after it on its host, null at the ends."""
    order = ["host", "path", "k1", "k2"]
    spark = lined.sparkSession
    # Written down once: partition numbers must not change between the uses below.
    dealt = stored(lined.repartitionByRange(partitions(spark), *order).select(
        "*", F.spark_partition_id().alias("part")), "page-lines")
    near = F.struct("host", "codes")
    inside = Window.partitionBy("part").orderBy(*order)
    ends = dealt.groupBy("part").agg(
        F.min_by(near, F.struct(*order)).alias("first"),
        F.max_by(near, F.struct(*order)).alias("last"))
    # One row per partition: the only window without a key sees no pages.
    line = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(line).alias("before_part"),
                       F.lead("first").over(line).alias("after_part"))
    found = dealt.select("*", F.lag(near).over(inside).alias("before"),
                         F.lead(near).over(inside).alias("after")).join(ends, "part").select(
        "host", "k1", "k2", "codes", "kinds",
        F.coalesce("before", "before_part").alias("before"),
        F.coalesce("after", "after_part").alias("after"))
    return found.select("k1", "k2", "codes", "kinds", *(
        F.when(F.col(f"{side}.host") == F.col("host"), F.col(f"{side}.codes")).alias(side)
        for side in ("before", "after")))


def deletions(pairs: DataFrame) -> DataFrame:
    """Key and the indexes of the lines to delete, of pages that lose any; once for equal rows."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            k1, k2, drops = [], [], []
            for row in batch.to_pylist():
                sides = [row[s] for s in ("before", "after") if row[s] is not None]
                loose = [i for i, kind in enumerate(row["kinds"]) if kind == 1]
                if loose and sides:
                    gone = template(row["codes"], sides).intersection(loose)
                    if gone:
                        k1.append(row["k1"])
                        k2.append(row["k2"])
                        drops.append(sorted(gone))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(drops, pa.list_(pa.int32()))], names=["k1", "k2", "drops"])

    rows = pairs.mapInArrow(align, "k1 bigint, k2 bigint, drops array<int>")
    # Equal rows stand side by side and see different neighbours: all take the greatest list.
    return rows.groupBy("k1", "k2").agg(F.max("drops").alias("drops"))


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """page_id, url and text of every page."""
    rows = located(pages, page_id, url, html)
    gone = stored(deletions(neighboured(coded(rows))), "page-deletions")
    kind = rows.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for value, drops in zip(batch["html"], batch["drops"].to_pylist()):
                lines = lines_of(value.as_py() or "")
                drops = set(drops or ())
                texts.append(" ".join(
                    text for i, ((text, _, _), kind) in enumerate(zip(lines, candidates(lines)))
                    if kind and i not in drops))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])

    return rows.select("page_id", "url", "html", "k1", "k2").join(gone, ["k1", "k2"], "left").select(
        "page_id", "url", "html", "drops").mapInArrow(
        write, f"page_id {kind}, url string, text string")
