"""Main text of web pages: what their markup names, and what the page next door has not.

A page is cut into lines: the text of one block-level element each, character references
decoded, white space made one space, empty lines left out.

Every page is compared with the page that differs least by URL: pages of a host are
ordered by URL path, and of the two beside it the one that shares the longer beginning of
the path is taken. All lines of both are aligned by their longest common subsequence, and
shared lines, which belong to the site, are deleted. Then the page's markup is checked:

- Lines of elements that are no text of the page go, shared or not: forms, menus, footers,
  sidebars, notices, adverts, reader comments, hidden ones, headers outside the article.
- If the page names its article (article, articleBody, or else main), only the article's
  lines are text, and those that the page next door has too come back: they are copied or
  quoted there.

Pages of a host with the same lines but for those that markup rules out are copies, which
would delete each other; they count as one page, that of the smallest path. Where the other
page has all lines of this one that markup leaves, it says nothing about them: the other
neighbour is taken, and if that has them all too, all lines stay. So do those of a page
without neighbours.

Lines meet as 64-bit hashes, pages as 128-bit ones; texts are moved once, to their verdicts.
Hot hosts are cut into chunks along the order of their paths.

A null or empty page has the empty text. A null url has no host and so no neighbour. Rows
are treated each, whatever their ids. Other columns are left out. An empty table gives no
rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import blocks, session, text_of, written
from rivulet.operators import ordered
from rivulet.session import rows_per_chunk

# Elements by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var img wbr br label picture source".split()
)
# Elements whose text is none of the page's.
ASIDE = frozenset(
    "nav footer aside form noscript template object svg math canvas video audio map button select "
    "datalist dialog menu head".split()
)
ROLES = frozenset(
    "navigation contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar tablist tooltip status".split()
)
# Words that name such elements in classes and ids.
NAMES = (
    "ad|ads|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|promo|promotion|"
    "banner|cookie|cookies|consent|gdpr|notice|notices|alert|newsletter|subscribe|subscription|"
    "social|share|sharing|comment|comments|respond|disqus|related|recommended|recommendations|"
    "sidebar|widget|widgets|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|"
    "footer|popup|modal|overlay|login|signup|toolbar|copyright|skip"
)
AFTER = "box|block|wrap|wrapper|container|area|list|bar|unit|slot|item|items|section|inner|top|bottom|left|right|form|panel|link|links|main|[0-9]+"
NAMED = re.compile(rf"(?!has|with|no[-_])(?:[a-z0-9]+[-_]+)*(?:{NAMES})(?:[-_]+(?:{AFTER}))*")
HEADS = re.compile(r"(?:[a-z0-9]+[-_]+)*(?:header|masthead|topbar)(?:[-_]+[a-z0-9]+)*")
COMMENTS = re.compile(r"(?:[a-z0-9]+[-_]+)*(?:comment|comments)(?:[-_]+[a-z0-9]+)*")

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"[\x20\x09-\x0D]+")
# An open element of these is closed by the next of its kind, within the second ones.
CLOSED_BY_NEXT = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
CLOSED_BY_NEXT = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSED_BY_NEXT.items()}

HEAD = frozenset("title meta link script style base noscript template".split())


class _Not(frozenset):
    """All names but these."""

    def __contains__(self, tag) -> bool:
        return not frozenset.__contains__(self, tag)


BLOCKS = _Not(INLINE)
# What a paragraph is not closed through.
AROUND_P = _Not(INLINE | {"p"})

OPEN, MAIN, ARTICLE = 0, 1, 2
GONE = -1
# Bits that an alignment keeps at once.
TABLE = 1 << 31
# So many pages of a host always meet in one task.
FEW = 100


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _zone(tag: str, attributes: str, zone: int) -> int:
    """The zone of an element inside an element of ``zone``."""
    if zone == GONE or tag in ASIDE or (tag == "header" and zone == OPEN):
        return GONE
    if attributes and not attributes.isspace():
        a = _attributes(attributes)
        role = a.get("role", "").lower()
        names = f"{a.get('class', '')} {a.get('id', '')}".lower().split()
        if "hidden" in a or a.get("aria-hidden") == "true" or role in ROLES:
            return GONE
        if "display:none" in a.get("style", "").replace(" ", "").lower():
            return GONE
        if role == "banner" and zone == OPEN:
            return GONE
        if tag == "article" or role == "article":
            if any(COMMENTS.fullmatch(n) for n in names):
                return GONE
        elif tag not in ("html", "body", "main"):
            if any(NAMED.fullmatch(n) for n in names):
                return GONE
            if zone == OPEN and any(HEADS.fullmatch(n) for n in names):
                return GONE
        if a.get("itemprop", "").lower() == "articlebody" or role == "article":
            return ARTICLE
        if role == "main":
            return max(zone, MAIN)
    if tag == "article":
        return ARTICLE
    return max(zone, MAIN) if tag == "main" else zone


def lines(page: str) -> list[tuple[str, int]]:
    """The page's lines that markup does not rule out, and their zones."""
    return [line for line in whole_lines(page) if line[1] != GONE]


def whole_lines(page: str) -> list[tuple[str, int]]:
    """All lines of the page and their zones; what markup rules out inside a line is a line."""
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    ruled_out: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the zones around them
    zone, of_line, at, n = OPEN, OPEN, 0, len(page)

    def add(text: str) -> None:
        nonlocal of_line
        if zone == GONE:
            ruled_out.append(text)
            return
        if not pieces:
            of_line = zone
        pieces.append(text)

    def end_line() -> None:
        for some, its_zone in ((pieces, of_line), (ruled_out, GONE)):
            if some:
                text = SPACES.sub(" ", "".join(some)).strip(" ")
                some.clear()
                if text:
                    out.append((text, its_zone))

    def close(names: frozenset | tuple, within: frozenset | tuple = ()) -> None:
        """Close the innermost open element of these names, and all inside it; it is not
        looked for outside of elements of the second names."""
        nonlocal zone
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                if any(tag not in INLINE for tag, _ in stack[i:]):
                    end_line()
                zone = stack[i][1]
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    while at < n:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = n
        if open_at > at:
            text = page[at:open_at]
            add(html.unescape(text) if "&" in text else text)
        if open_at == n:
            break
        if page.startswith("<!--", open_at):
            end = page.find("-->", open_at + 2)
            at = n if end < 0 else end + 3
            continue
        tag_at = TAG.match(page, open_at)
        if tag_at is None:
            if page[open_at + 1 : open_at + 2] in ("!", "?", "/") or page[open_at + 1 : open_at + 2].isalpha():
                end = page.find(">", open_at)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = open_at + 1
            continue
        at = tag_at.end()
        closing, tag, attributes = tag_at.group(1, 2, 3) if tag_at[2] else tag_at.group(4, 5, 6)
        tag = tag.lower()
        if closing:
            close((tag,), BLOCKS if tag in INLINE else ())
            if tag not in INLINE:
                end_line()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = n if end is None else end.end()
            continue
        if stack and stack[-1][0] == "head" and tag not in HEAD:
            close(("head",))
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            # A paragraph ends where the next block begins.
            close(("p",), AROUND_P)
            if tag in CLOSED_BY_NEXT:
                close(*CLOSED_BY_NEXT[tag])
            end_line()
        if tag in VOID:
            continue
        inner = _zone(tag, attributes, zone)
        if inner != zone and tag in INLINE and inner != GONE:
            inner = zone
        stack.append((tag, zone))
        zone = inner
    end_line()
    return out


def _common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Bit j of a row is unset if taking b[j] lengthens the subsequence with the rows so far.
    """
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE and len(a) > 1:
        # Rows are kept for one half at a time: cut where both halves have most in common.
        half = len(a) // 2
        front = _lengths(a[:half], b)
        back = _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int((front + back).argmax())
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows = list(_rows(a, b))
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            found.append(i)
    return found[::-1]


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    raw = np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8)
    unset = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.append(0, np.cumsum(unset))


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places of the lines of ``a`` that are aligned with equal lines of ``b``."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    inner = _common(a[start : len(a) - end], b[start : len(b) - end])
    return [*range(start), *[start + i for i in inner], *range(len(a) - end, len(a))]


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, lines, zones, best) of each page: all its lines; ``best`` is the highest
    zone of those that markup leaves."""

    def run(batches):
        for batch in blocks(batches, "html"):
            found = [whole_lines(page) for page in batch.column("html").to_pylist()]
            ends = pa.array(np.cumsum([0, *[len(f) for f in found]], dtype=np.int32))
            flat = [line for some in found for line in some]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.ListArray.from_arrays(ends, pa.array([t for t, _ in flat], pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array([z for _, z in flat], pa.int8())),
                    pa.array([max([OPEN, *[z for _, z in some]]) for some in found], pa.int8()),
                ],
                ["page_id", "url", "lines", "zones", "best"],
            )

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    columns = f"page_id {id_type}, url string, lines array<string>, zones array<tinyint>, best tinyint"
    return rows.mapInArrow(run, columns)


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    return F.when(found != "", found)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _alike(a: Column, b: Column) -> Column:
    """The characters two paths begin with in common; -1 without a second path."""
    pairs = F.arrays_zip(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    same = lambda p: F.coalesce(p["x"] == p["y"], F.lit(False))
    # A path differs from itself nowhere, from another at its first difference.
    step = lambda s, p: F.struct(
        (s["n"] + F.when(s["go"] & same(p), 1).otherwise(0)).alias("n"), (s["go"] & same(p)).alias("go")
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("go"))
    return F.when(b.isNull(), -1).otherwise(F.aggregate(pairs, start, step, lambda s: s["n"]))


def site_lines(told: DataFrame) -> DataFrame:
    """(host, key, key2, keep) of distinct pages (host, key, key2, path, hashes, left): which
    of their ``left`` lines, those that markup leaves, the page next door has not."""
    distinct = told.where("host is not null").groupBy("host", "key", "key2").agg(
        F.min(F.struct("path", "hashes", "left")).alias("page")
    )
    distinct = written(distinct.select("host", "key", "key2", "page.*"), "pages-distinct")
    # A host is hot if its pages are more than a task's share.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_chunk = min(rows_per_chunk(distinct.sparkSession), max(FEW, distinct.count() // tasks))
    near = ordered.beside(
        distinct, ["host"], ["path", "key", "key2"], F.struct("path", "hashes"), "before", "after",
        rows_per_chunk=per_chunk,
    )
    first = F.when(_alike(F.col("path"), F.col("after.path")) > _alike(F.col("path"), F.col("before.path")), 1)
    met = near.select(
        "host",
        "key",
        "key2",
        "hashes",
        "left",
        F.col("before.hashes").alias("one"),
        F.col("after.hashes").alias("two"),
        F.coalesce(first, F.lit(0)).alias("second_first"),
    )

    def run(batches):
        for batch in batches:
            keeps = []
            for mine, left, one, two, swap in zip(
                *[batch.column(i).to_pylist() for i in range(3, 8)], strict=True
            ):
                keep = [True] * sum(left)
                for beside in (two, one) if swap else (one, two):
                    if beside is None:
                        continue
                    shared = set(shared_lines(mine, beside))
                    lacks = [i not in shared for i, mark in enumerate(left) if mark]
                    if any(lacks):
                        keep = lacks
                        break
                keeps.append(keep)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(keeps, pa.list_(pa.bool_()))],
                ["host", "key", "key2", "keep"],
            )

    return met.mapInArrow(run, "host string, key long, key2 long, keep array<boolean>")


def main_text(pages: DataFrame) -> DataFrame:
    """For each row: page_id, url, text, n_chars; n_lines, those that markup leaves, and
    n_shared, those of them that the page next door has too."""
    session(pages.sparkSession)
    hashes = F.transform("lines", lambda line: F.xxhash64(line))
    left = F.filter("hashes", lambda _, i: F.get(F.col("zones"), i) > GONE)
    held = parsed(pages).withColumn("hashes", hashes).withColumn("own", left)
    keys = [host(F.col("url")).alias("host"), F.xxhash64("own").alias("key"), F.xxhash64(F.lit(1), "own").alias("key2")]

    told = held.where(F.size("own") > 0).select(
        *keys, path(F.col("url")).alias("path"), "hashes", F.transform("zones", lambda z: z > GONE).alias("left")
    )
    # The pages are cut into lines again: keeping the lines would take more disk.
    chosen = F.filter("lines", lambda _, i: F.get(F.col("zones"), i) == F.col("best"))
    asked = held.select(
        "page_id", "url", *keys, "best", chosen.alias("lines"), F.size("own").cast("long").alias("n_lines")
    )
    # Verdicts are small; hashing them spares sorting the texts.
    met = asked.join(site_lines(told).hint("shuffle_hash"), ["host", "key", "key2"], "left")
    # All lines of an article stay. Where none is named, the chosen lines are those judged.
    kept = F.filter("lines", lambda _, i: (F.col("best") > OPEN) | F.coalesce(F.get(F.col("keep"), i), F.lit(True)))
    shared = F.when(F.col("keep").isNotNull(), F.size(F.filter("keep", lambda k: ~k))).otherwise(0)
    texts = met.withColumn("text", F.array_join(kept, "\n\n")).withColumn("n_shared", shared.cast("long"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")
