"""Main text of web pages, by comparison with the page of the nearest URL, checked by their markup.

A page becomes text lines, one per block of markup. Every page is compared with the nearest page: of the same
host, next to it when the host's pages are ordered by URL path, with the longer
common beginning of the path (the earlier one of two). The two pages' lines are
aligned by a longest common subsequence; the lines they share are what a site
repeats, and go. If they are more than COPY_SHARE of the characters of the page's text, the neighbour
is a copy of the page rather than another page of its site, and says nothing about it.

Markup is the check on that, since sites vary their menus and adverts, which neighbours then do not share,
and articles quote the same passages, which they do:

- Lines in menus, headers, footers, sidebars, adverts, notices, forms, comments and
  scripts, by element or by the words of class, id and role, go whether they are shared or not.
- A line inside an article or main element that is shared stays if it ends like a sentence, or if it stands inside such an
  element of the neighbour too and has SHORT_PROSE words or more: both pages then say that it is text.
- A line outside such an element that markup does not know goes on a page that has one, unless the
  comparison finds it to be the page's own and it is a paragraph of LONG_PROSE words or more. On a page without
  one, all lines that are the page's own are its text.

A page without a neighbour is decided by markup. NULL html counts as empty and gives empty text. A NULL or unusual url has an
empty host or path; such pages are neighbours of each other. Repeated rows are
pages of their own, ties of the order go by page_id. A page that ends inside
markup is read up to there. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from urllib.parse import urlsplit

import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.llm.common import map_rows, read, with_may_be_among, written

# Fixed values of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark"
    " q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LOOSE = frozenset("p li dt dd tr td th option".split())  # end where their like begins or their parent ends
DROPPED = frozenset(
    "head title nav header footer aside form script style noscript template svg canvas iframe object"
    " button select textarea menu dialog audio video".split()
)
RAW = "script|style|noscript|template|textarea|iframe"
MAIN = frozenset("article main".split())
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|menus?|nav|navbar|navigation|breadcrumbs?"
    r"|header|masthead|footer|sidebar|aside|notice|notification|cookies?|consent|gdpr|alert|popup|modal|overlay"
    r"|comments?|disqus|replies|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search"
    r"|complementary|contentinfo|skip)(?=$|[\s_-])",
    re.I,
)
COPY_SHARE = 0.8
LONG_PROSE = 25  # words
SHORT_PROSE = 8  # words of a line that does not end like a sentence
HEADER_OF_MAIN = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", re.I)  # inside an article it holds the title

# What markup says of a line.
MAIN_LINE, OTHER_LINE, DROPPED_LINE = 0, 1, 2

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NEVER_TEXT = frozenset(["head"])
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def names_drop(attrs: str, inside: bool) -> bool:
    """Whether class, id or role name an element that holds no text of the page."""
    for found in NAMED.findall(attrs):
        names = "".join(found)
        if DROPPED_NAMES.search(HEADER_OF_MAIN.sub("", names) if inside else names):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int]]:
    """The lines of a page and what markup says of each; scripts, styles and the like have none."""
    lines: list[tuple[str, int]] = []
    pieces: list[str] = []
    inside = 0  # main elements that are open
    skip, depth = None, 0  # the element that is being dropped, and how many of its name are open
    around: list[str] = []  # what stands before it on its line, where it is part of one
    at = 0

    def close() -> None:
        line = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if line:
            lines.append((line, DROPPED_LINE if skip is not None else MAIN_LINE if inside else OTHER_LINE))

    for token in TOKEN.finditer(page):
        if token.start() > at and skip not in NEVER_TEXT:
            pieces.append(page[at : token.start()])
        at = token.end()
        if not token["tag"]:
            continue
        tag, ends = token["tag"].lower(), token["end"] == "/"
        if tag not in INLINE:
            close()
        if skip is not None:
            if skip == "head" and tag == "body" and not ends:
                skip = None  # it began a line of its own, so nothing stands before it
            elif skip in LOOSE and (tag in LOOSE or ends) and tag not in INLINE and not (ends and tag == skip):
                skip = None  # and the token counts
            else:
                depth += (tag == skip) * (-1 if ends else 1)
                if depth <= 0:
                    close()
                    skip = None
                    pieces.extend(around)
                    around.clear()
                continue
        if tag in INLINE and not token["attrs"]:
            continue
        drops = not ends and tag not in VOID and tag not in ("html", "body") and (
            (tag in DROPPED and not (tag == "header" and inside))
            or bool(token["attrs"]) and names_drop(token["attrs"], inside > 0)
        )
        if drops:
            if not token["attrs"].endswith("/"):
                around.extend(pieces)
                pieces.clear()
                skip, depth = tag, 1
        elif tag in MAIN:
            inside = max(0, inside + (-1 if ends else 1))
    if at < len(page) and skip not in NEVER_TEXT:
        pieces.append(page[at:])
    close()
    skip = None
    pieces.extend(around)
    close()
    return lines


def shared_lines(mine: list[int], theirs: list[int]) -> dict[int, int]:
    """Places in `mine` and `theirs` of a longest common subsequence, by its chains of matches."""
    start, stop, other = 0, len(mine), len(theirs)
    while start < min(stop, other) and mine[start] == theirs[start]:
        start += 1
    while min(stop, other) > start and mine[stop - 1] == theirs[other - 1]:
        stop, other = stop - 1, other - 1
    found = {k: k for k in range(start)} | {stop + k: other + k for k in range(len(mine) - stop)}
    places: dict[int, list[int]] = {}
    for j in range(start, other):
        places.setdefault(theirs[j], []).append(j)
    ends: list[int] = []  # smallest end in `theirs` of a chain of each length
    chains: list[tuple] = []
    for i in range(start, stop):
        for j in reversed(places.get(mine[i], ())):
            k = bisect_left(ends, j)
            link = (i, j, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            elif j < ends[k]:
                ends[k], chains[k] = j, link
    link = chains[-1] if chains else None
    while link:
        found[link[0]] = link[1]
        link = link[2]
    return found


def prose(line: str) -> int:
    """How a line reads: 3 a long paragraph, 2 a sentence, 1 many words, 0 a label."""
    words, ends = len(line.split()), line.rstrip("\"'”»)]")[-1:] in tuple(".!?…:;")
    return (3 if words >= LONG_PROSE else 2) if ends else int(words >= SHORT_PROSE)


def by_markup(kinds: list[int]) -> list[int]:
    """The places of the lines that are text as far as markup knows."""
    kind = MAIN_LINE if MAIN_LINE in kinds else OTHER_LINE
    return [k for k, own in enumerate(kinds) if own == kind]


def by_comparison(kinds: list[int], reads: list[int], sizes: list[int], shared: dict[int, int], their_kinds: list[int]) -> list[int]:
    """The places of the lines that are text, once the lines shared with the neighbour are known."""
    plain = by_markup(kinds)
    if sum(sizes[k] for k in plain if k in shared) > COPY_SHARE * sum(sizes[k] for k in plain):
        return plain
    has_main, kept = MAIN_LINE in kinds, []
    for k, kind in enumerate(kinds):
        if kind == MAIN_LINE:
            keep = k not in shared or reads[k] >= (1 if their_kinds[shared[k]] == MAIN_LINE else 2)
        elif kind == OTHER_LINE:
            keep = k not in shared and (not has_main or reads[k] == 3)
        else:
            keep = False
        if keep:
            kept.append(k)
    return kept


def host_and_path(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    return parts.netloc.lower(), re.sub(r"(\.html?)?/*$", "", parts.path)


def parse_pages(pages: DataFrame) -> DataFrame:
    """A row per page with its row number, host and path, and its lines: text, kind, hash, size and how it reads.

    The text of lines that markup drops is left out; they are compared by their hash only.
    """

    def work(columns: list[list]) -> list[list]:
        found = []
        for row, page_id, url, page in zip(*columns):
            lines = page_lines(page or "")
            found.append((
                row, page_id, url, *host_and_path(url),
                [None if kind == DROPPED_LINE else line for line, kind in lines],
                [kind for _, kind in lines],
                [xxhash.xxh64_intdigest(line) - (1 << 63) for line, _ in lines],
                [len(line) for line, _ in lines],
                [prose(line) for line, _ in lines],
            ))
        return [list(c) for c in zip(*found)] or [[]] * 10

    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "html")
    return map_rows(
        rows,
        work,
        "row long, page_id long, url string, host string, path string, lines array<string>, kinds array<tinyint>,"
        " hashes array<long>, sizes array<int>, reads array<tinyint>",
        rows=256,
    )


def neighbours(pages: DataFrame) -> DataFrame:
    """(row, partner): the nearest page by URL path within each host.

    The order is that of one sort over all hosts by ranges, so a host with very many pages is
    spread over tasks; ranks come from the number of rows in each range.
    """
    keys = ["host", "path", "page_id", "row"]
    ordered = pages.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    spark = pages.sparkSession
    ranges = written(ordered.withColumn("place", F.monotonically_increasing_id()), "url-order")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    # One row per range of the sort.
    sizes = {r[0]: r[1] for r in ranges.groupBy(part.alias("part")).count().collect()}
    offsets, total = [], 0
    for k in sorted(sizes):
        offsets.append((k, total))
        total += sizes[k]
    starts = F.broadcast(spark.createDataFrame(offsets, "part long, start long"))
    ranked = ranges.withColumn("part", part).join(starts, "part").withColumn("rank", F.col("start") + within)
    ranked = ranked.select("rank", "row", "host", "path")
    after = ranked.select(
        (F.col("rank") - 1).alias("rank"), F.col("row").alias("next"), F.col("host").alias("h"), F.col("path").alias("p")
    )
    pairs = ranked.join(after, "rank").where("host = h")
    length = F.greatest(F.length("path"), F.length("p"))
    same = F.aggregate(
        F.sequence(F.lit(1), F.greatest(length, F.lit(1))),
        F.lit(0),
        lambda best, k: F.when((best == k - 1) & (F.substr("path", F.lit(1), k) == F.substr("p", F.lit(1), k)), k).otherwise(best),
    )
    pairs = pairs.select("row", "next", same.alias("same"))
    both = pairs.select("row", F.col("next").alias("partner"), "same", F.lit(0).alias("earlier")).unionAll(
        pairs.select(F.col("next").alias("row"), F.col("row").alias("partner"), "same", F.lit(1).alias("earlier"))
    )
    return both.groupBy("row").agg(F.max_by("partner", F.struct("same", "earlier")).alias("partner"))


def compared(parsed: DataFrame) -> DataFrame:
    """(row, kept, n_shared) of every page that has a neighbour: the places of the lines that are text.

    Only hashes, kinds and sizes of lines meet, not their texts.
    """
    partners = neighbours(parsed.select("host", "path", "page_id", "row"))
    theirs = parsed.select(F.col("row").alias("partner"), F.col("hashes").alias("their_hashes"), F.col("kinds").alias("their_kinds"))
    met = partners.join(theirs, "partner").select("row", "their_hashes", "their_kinds")
    pairs = parsed.select("row", "hashes", "kinds", "sizes", "reads").join(met, "row")

    def work(columns: list[list]) -> list[list]:
        kept, counts = [], []
        for _, hashes, kinds, sizes, reads, their_hashes, their_kinds in zip(*columns):
            shared = shared_lines(hashes, their_hashes)
            kept.append(by_comparison(kinds, reads, sizes, shared, their_kinds))
            counts.append(len(shared))
        return [columns[0], kept, counts]

    names = ["row", "hashes", "kinds", "sizes", "reads", "their_hashes", "their_kinds"]
    return map_rows(pairs.select(*names), work, "row long, kept array<int>, n_shared int")


def text_of(lines: str, kept: str) -> str:
    """SQL for the lines at some places, joined by a space."""
    return f"array_join(transform({kept}, k -> {lines}[k]), ' ')"


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page.

    Texts are shuffled only of pages for which the comparison finds anything else than markup alone.
    """
    parsed = written(parse_pages(pages), "page-lines")
    main = f"exists(kinds, k -> k = {MAIN_LINE})"
    kind = f"CASE WHEN {main} THEN {MAIN_LINE} ELSE {OTHER_LINE} END"
    parsed = parsed.withColumn("plain", F.expr(f"filter(sequence(0, size(kinds) - 1), k -> size(kinds) > 0 AND kinds[k] = {kind})"))
    verdicts = compared(parsed).join(parsed.select("row", "plain"), "row").where("kept <> plain").select("row", "kept")
    verdicts = written(verdicts, "verdicts")
    flagged = with_may_be_among(parsed.select("row", "page_id", "url", "lines", "plain"), "row", verdicts, "row", "differs")
    plain = flagged.where("NOT differs").select("page_id", "url", F.expr(text_of("lines", "plain")).alias("text"))
    other = flagged.where("differs").join(verdicts, "row", "left").withColumn("places", F.coalesce("kept", "plain"))
    return plain.unionByName(other.select("page_id", "url", F.expr(text_of("lines", "places")).alias("text")))


def op6_nearest_url(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages", "page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
