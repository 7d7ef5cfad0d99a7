"""Main text of web pages: marked articles or open lines, and nearest-URL page differencing of all pages.

A page is cut into text lines, one per block element, each seen as *article*
(inside an ``article`` or ``main`` element), *furniture* (menus, headers,
footers, sidebars, notices, adverts, forms, comments, by element, role or
class) or *open*. Furniture is never text, but a class or id does not make any
of an article inside it: such articles are the text of a page that marks none
elsewhere (those inside comments, adverts and the like, of one without open
lines too). Where a page marks an article, its lines are its text, otherwise its
open lines. Every page's text is aligned with that of the nearest page of the
same host (pages in order of URL path; of the two neighbours the one with the
longer common path) by longest common subsequence, and shared lines, the
template, are deleted. A marked article is not compared with a copy of it (the
lines they share are half of the characters of either), as all of it would be
deleted from both; the other neighbour is taken then.

Results: null html is an empty page with empty text; a page without a host
pairs with other pages without one; a page alone on its host keeps its open
lines; repeated rows are pages of their own and delete each other's lines only
if they mark no article and are nearest to each other with other content, so
equal pages (all lines shared) keep theirs. Entities cut off at the end of a
page are decoded as far as they go. An empty table gives an empty one.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import batches_of, pieces
from apexlake.operators.ranking import number_rows
from apexlake.session import write_once

# Elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title button select textarea option datalist".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CLOSES_P = BLOCKS - {"html", "body"}
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"sidebar|side-?bar|menu|nav(?:bar|igation)?|breadcrumbs?|footer|header|masthead|comments?|replies|respond|disqus|newsletter|"
    r"subscribe|signup|share|sharing|social|related|widget|toolbar|search|login|pagination|pager|skip-?link)(?=$|[\s_-])", re.I)
# Names that only tell how a page is laid out.
LAYOUT_NAMES = re.compile(r"(?<![^\s_-])(?:no|not|non|has|with|without)[_-]\S+", re.I)
# What may stand in a head; anything else ends it.
HEAD = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
# An article's own classes often mention such names (comments-open); one of these alone says that it is none.
NO_ARTICLE = frozenset("comment comments reply replies ad advert advertisement sponsored promo teaser related widget".split())
OTHERS = NO_ARTICLE | {"ads", "adverts", "disqus", "respond"}
IN, NAMED, NAMED_OTHER, OUT = range(4)  # text; furniture by a name, of the page's layout or of other texts; furniture for sure
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

# A raw element up to its end tag, a comment, another declaration, or a tag; each may be cut off by the end of the page.
TOKEN = re.compile(
    r"<(script|style|noscript|template|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
BATCH_BYTES = 4 << 20  # of line hashes sent to Python at once, or one page


def _furniture(tag: str, attributes: str, in_article: bool) -> int:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return OUT
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return IN
    found = IN
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return OUT
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            names = {n.lower() for n in FURNITURE_NAMES.findall(LAYOUT_NAMES.sub("", value))}
            if in_article:
                names.discard("header")  # as the element
            if names:
                found = max(found, NAMED if OTHERS.isdisjoint(names) else NAMED_OTHER)
        if name == "class" and tag == "article" and not NO_ARTICLE.isdisjoint(value.lower().split()):
            return OUT
        if name == "role" and value.lower() in FURNITURE_ROLES or name == "style" and "display:none" in value.replace(" ", ""):
            return OUT
    return found


def lines_of(html: str) -> tuple[list[str], list[str], bool]:
    """``(article lines, open lines, whether an article is marked)`` of a page."""
    article: list[str] = []
    open_: list[str] = []
    buffer: list[str] = []
    within: dict[int, list[str]] = {NAMED: [], NAMED_OTHER: []}  # lines of articles inside furniture by a name
    stack: list[tuple[str, int, bool, int]] = []  # element, inside furniture, inside an article, furniture around that article
    opened: dict[str, int] = {}  # elements on the stack by name: an end tag that closes none is passed over at once
    marked = False
    state = (IN, False, IN)

    def end_line() -> None:
        if buffer:
            line = SPACE.sub(" ", html_lib.unescape("".join(buffer))).strip()
            buffer.clear()
            if line and not state[0]:
                (within[state[2]] if state[2] else article if state[1] else open_).append(line)

    def pop_to(index: int) -> None:
        nonlocal state
        for name, *_ in stack[index:]:
            opened[name] -= 1
        del stack[index:]
        state = stack[-1][1:] if stack else (IN, False, IN)

    def text(part: str) -> None:
        if stack and stack[-1][0] == "head" and not part.isspace() and part:
            pop_to(len(stack) - 1)
        if part and not state[0]:
            buffer.append(part)

    at = 0
    for token in TOKEN.finditer(html):
        text(html[at:token.start()])
        at = token.end()
        closing, tag, attributes = token[2], token[3], token[4]
        if tag is None:
            closing, tag, attributes = token[5], token[6], token[7]
        if tag is None:
            continue
        tag = tag.lower()
        if not closing and tag not in HEAD and stack and stack[-1][0] == "head":
            pop_to(len(stack) - 1)
        if tag in ("br", "td", "th"):
            text(" ")
        if tag in VOID and tag != "hr":
            continue
        if tag in BLOCKS:
            end_line()
        if closing:
            for k in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            continue
        if tag == "hr":
            continue
        if tag in CLOSES_P and opened.get("p"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        in_article = state[1] or tag in ("article", "main")
        own = OUT if tag in SKIPPED else _furniture(tag, attributes, state[1])
        out, around = max(state[0], own), state[2]
        if tag in ("article", "main") and out in (NAMED, NAMED_OTHER):
            out, around = IN, max(out, around)
        if in_article and not out and not around:
            marked = True
        if out and not state[0]:
            # Furniture in the middle of a line ends what stands before it, so that no text of it is joined.
            if tag not in BLOCKS and tag in SKIPPED:
                text(" ")
        if not attributes.rstrip().endswith("/") or tag in BLOCKS:
            stack.append((tag, out, in_article, around))
            opened[tag] = opened.get(tag, 0) + 1
            state = stack[-1][1:]
    rest = html[at:]
    cut = rest.rfind("<")
    text(rest if cut < 0 or not re.match(r"</?[a-zA-Z!]|<\Z|</\Z", rest[cut:]) else rest[:cut])
    end_line()
    if not marked:
        held = within[NAMED] or ([] if open_ else within[NAMED_OTHER])
        if held:
            return held, open_, True
    return article, open_, marked


def shared_lines(own: list, other: list) -> list[bool]:
    """Which lines of ``own`` are on a longest common subsequence with ``other``.

    Bits of one number per line of ``own`` mark where in ``other`` the length
    grows, so memory is the product of the two line counts in bits.
    """
    place: dict = {}
    for j, line in enumerate(other):
        place[line] = place.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, v = [], full
    for line in own:
        match = place.get(line, 0)
        u = v & match
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    shared, j = [False] * len(own), len(other) - 1
    for i in range(len(own) - 1, -1, -1):
        while j >= 0 and rows[i] >> j & 1:  # no growth at this line of the other page
            j -= 1
        if j < 0:
            break
        before = rows[i - 1] if i else full
        if before >> j & 1 and own[i] == other[j]:
            shared[i] = True
            j -= 1
    return shared


def _common_steps(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def differenced(lines: list, path: str, neighbours: list[tuple[str, list]]) -> list[bool]:
    """Which lines are left after those shared with the nearest neighbour are deleted; all of them if the neighbour is an equal page."""
    neighbours = [n for n in neighbours if n[1] and n[1] != lines]
    if not neighbours:
        return [True] * len(lines)
    nearest = max(neighbours, key=lambda n: _common_steps(path, n[0]))
    return [not shared for shared in shared_lines(lines, nearest[1])]


def is_copy(lines: list, sizes: list[int], other: list, other_size: int) -> bool:
    """Whether two articles are one: the lines they share are at least half of the characters of either."""
    shared = sum(size for size, both in zip(sizes, shared_lines(lines, other)) if both)
    return 2 * shared >= min(sum(sizes), other_size)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page. Other columns are not read."""
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def parse(batches):
        for batch in batches:
            for piece in pieces(batch, "html"):
                found = [lines_of(page or "") for page in piece.column("html").to_pylist()]
                texts = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array([marked for _, _, marked in found], pa.bool_()),
                     pa.array([article if marked else open_ for article, open_, marked in found], texts),
                     pa.array([open_ if marked else None for _, open_, marked in found], texts)],
                    names=["page_id", "url", "marked", "lines", "beside"])

    kind = source.schema["page_id"].dataType.simpleString()
    parsed = source.mapInArrow(parse, f"page_id {kind}, url string, marked boolean, lines array<string>, beside array<string>")
    parsed = write_once(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    # Lines are compared by hash, so that texts stay where they are. A page has its text, and its open lines beside a marked one.
    address = F.coalesce("url", F.lit(""))
    open_ = F.when(F.col("marked"), F.col("beside")).otherwise(F.col("lines"))
    each = F.explode(F.array(F.struct(F.lit(False).alias("outside"), F.col("lines")), F.struct(F.lit(True).alias("outside"), open_.alias("lines"))))
    compared = parsed.select(
        F.lower(F.regexp_extract(address, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(address, r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        "page_id", "url", "row", "marked", each.alias("side")).where(F.size("side.lines") > 0)
    compared = compared.select(
        "host", "path", "page_id", "url", "row", "marked", "side.outside", F.xxhash64("side.lines").alias("content"),
        F.transform("side.lines", lambda line: F.xxhash64(line)).alias("lines"),
        F.transform("side.lines", lambda line: F.length(line)).alias("sizes"))
    order = [F.col("path"), F.col("url"), F.col("page_id"), F.col("content")]
    placed = write_once(number_rows(compared, ["outside", "host"], order, "place").drop("page_id", "url", "content"), "placed")

    def neighbour(step: int, name: str) -> DataFrame:
        size = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)
        return placed.select("outside", "host", (F.col("place") - step).alias("place"), F.struct("path", "lines", size.alias("size")).alias(name))

    # A page that marks an article is compared by its text, another by its open lines.
    by = ["outside", "host", "place"]
    paired = placed.where(F.col("marked") != F.col("outside")).join(neighbour(-1, "before"), by, "left").join(neighbour(1, "after"), by, "left")

    def difference(batches):
        for batch in batches:
            rows, left = [], []
            for row in batch.to_pylist():
                near = [n for n in (row["before"], row["after"]) if n]
                if row["marked"]:
                    near = [n for n in near if not is_copy(row["lines"], row["sizes"], n["lines"], n["size"])]
                kept = differenced(row["lines"], row["path"], [(n["path"], n["lines"]) for n in near])
                if not all(kept):
                    rows.append(row["row"])
                    left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(left, pa.list_(pa.bool_()))], names=["row", "kept"])

    found = paired.select("row", "marked", "path", "lines", "sizes", "before", "after").mapInArrow(difference, "row long, kept array<boolean>")
    with batches_of(pages.sparkSession, BATCH_BYTES):
        found = write_once(found, "differences")
    # A bit a page tells which ones change, so that only their texts meet the differences.
    bucket, bit = F.bitmap_bucket_number("row").alias("bucket"), F.bitmap_bit_position("row")
    bits = F.broadcast(found.groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias("bits")))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    told = parsed.withColumn("bucket", bucket).join(bits, "bucket", "left").withColumn(
        "changed", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False)))
    same = told.where(~F.col("changed")).select("page_id", "url", "lines")
    less = told.where("changed").join(found, "row").select(
        "page_id", "url", F.filter("lines", lambda _, place: F.get("kept", place)).alias("lines"))
    return same.unionByName(less).select(
        "page_id", "url", F.array_join("lines", "\n").alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
