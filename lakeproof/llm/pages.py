"""Main text of web pages: site templates removed by counting element subtrees per host.

Every element outside the article is hashed with all it holds (tags, classes and text,
not the place). Spark counts on how many pages of a host each hash occurs; what recurs
on many of a host's pages is its template and goes. For blocks outside the article a few
pages are many however large the host is; inside it, and for short lines, it is half of all. Elements whose tag, role or class
says that they are no article go as well, so that a host of one page is cleaned too.

What remains is the article: inside ``main``, else ``article`` elements, else the body.
The text of a block has its white space collapsed; blocks follow each other with one space.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.support import in_slices, staged

#: A subtree is template if it is on so many pages of its host, and on this share of them.
LEAST_PAGES = 5
LEAST_SHARE = 0.5
#: Outside the article so many pages are enough, whatever share of the host they are,
ENOUGH_PAGES = 6
#: for a block of a kind in FURNITURE, or of so many words: a short line or cell may recur by chance.
ENOUGH_WORDS = 8
#: Inside an article only elements of these kinds and of so few words may be template: prose that recurs is text.
FURNITURE = frozenset("div section ul ol dl figure table".split())
FURNITURE_WORDS = 40
#: Tags below this depth open no element of their own, as in browsers; their text counts for the element above.
DEEPEST = 512

# Elements that never hold a main text, that have no end tag, and that begin a new block.
DROPPED = frozenset(
    "script style noscript template nav footer aside form button select option textarea input label fieldset iframe "
    "object embed svg math canvas audio video map menu dialog head title".split()
)
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Elements that end when another of them begins.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
        "menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert advertisement".split())
# Words of classes and ids that name what is no article.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|adslot|banner|sponsor\w*|promo\w*|nav(?:bar|igation|links?|menu)?|menu\w*|"
    r"breadcrumbs?|sidebar\w*|footer|(?:site|page|global|top)[_-]?header|masthead|topbar|cookies?|consent|gdpr|notices?|"
    r"notification|popup|modal|overlay|newsletter|"
    r"subscri\w*|signup|login|search\w*|share|sharing|social\w*|related|recommend\w*|comments?|comment-?\w*|disqus\w*|"
    r"replies|reply|respond|widget\w*|pagination|pager|skip-?link|tracking|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.IGNORECASE,
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:(>)|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in RAW}
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass
class Element:
    """An open or closed element: its place in the tree, whether a rule drops it, and its subtree's hash."""

    tag: str
    parent: int
    dropped: bool
    article: bool
    digest: int = 0
    words: int = 0
    hasher: object = field(default=None, repr=False)


@dataclass
class Page:
    """A parsed page: its elements, and its text as (element, words, whether a block begins before it)."""

    elements: list[Element]
    texts: list[tuple[int, str, bool]]


def host_of(url: str | None) -> str:
    """The host in lower case, without port and a leading ``www.``; empty if the address has none."""
    found = _HOST.match(url or "")
    return found[1].lower().removeprefix("www.") if found else ""


def _said(attributes: str) -> tuple[str, str]:
    """(class and id, role) of a start tag."""
    if not attributes or attributes.isspace():
        return "", ""
    named, role = [], ""
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "id"):
            named.append(m[2] or m[3] or m[4] or "")
        elif name == "role":
            role = (m[2] or m[3] or m[4] or "").lower()
    return " ".join(named), role


def _is_dropped(tag: str, named: str, role: str, inside_article: bool) -> bool:
    if tag in DROPPED or role in ROLES or tag == "header" and not inside_article:
        return True
    return bool(named) and tag not in ("html", "body", "main") and bool(BOILERPLATE.search(named))


def parse(source: str) -> Page:
    """One pass over the page; broken markup is read as far as it goes."""
    root = Element("", -1, False, False, hasher=xxhash.xxh64())
    elements, stack, texts = [root], [0], []
    fresh = True

    def close(depth: int) -> None:
        while len(stack) > depth:
            done = elements[stack.pop()]
            raw, done.hasher = done.hasher.digest(), None
            done.digest = int.from_bytes(raw, "big", signed=True)
            if stack:
                elements[stack[-1]].hasher.update(raw)
                elements[stack[-1]].words += done.words

    def say(raw: str) -> None:
        nonlocal fresh
        words = html.unescape(raw)
        if words:
            texts.append((stack[-1], words, fresh))
            fresh = False
            parts = words.split()
            elements[stack[-1]].words += len(parts)
            elements[stack[-1]].hasher.update(" ".join(parts).encode("utf-8", "surrogatepass"))

    at = 0
    while at < len(source):
        found = TOKEN.search(source, at)
        if not found:
            say(source[at:])
            break
        if found.start() > at:
            say(source[at:found.start()])
        at = found.end()
        if found[2] is None or found[4] is None:
            continue
        tag = found[2].lower()
        if tag not in INLINE:
            fresh = True
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    close(depth)
                    break
            continue
        if tag in VOID:
            elements[stack[-1]].hasher.update(tag.encode())
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(elements[stack[-1]].tag, ()):
            close(len(stack) - 1)
        if tag == "p":  # an open paragraph ends even below unclosed inline elements
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == "p":
                    close(depth)
                    break
                if elements[stack[depth]].tag not in INLINE:
                    break
        if len(stack) > DEEPEST:
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
            continue
        above = elements[stack[-1]]
        named, role = _said(found[3])
        article = above.article or tag in ("article", "main") or role in ("main", "article")
        dropped = above.dropped or _is_dropped(tag, named, role, above.article)
        element = Element(tag, stack[-1], dropped, article, hasher=xxhash.xxh64(f"<{tag} {named} {role}>"))
        elements.append(element)
        stack.append(len(elements) - 1)
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            element.hasher.update(source[at:end.start() if end else len(source)].encode("utf-8", "surrogatepass"))
            at = end.start() if end else len(source)
        if found[3].endswith("/") and tag not in INLINE and tag in ("svg", "path", "use"):
            close(len(stack) - 1)
    close(0)
    return Page(elements, texts)


def candidates(page: Page) -> list[bool]:
    """Which elements may be template: blocks outside the article, and short ones inside it that are no prose."""
    return [
        e.tag not in INLINE and e.tag not in ("", "html", "head", "body") and (
            not e.article or e.tag in FURNITURE and e.words <= FURNITURE_WORDS
        ) for e in page.elements
    ]


def keys(page: Page) -> list[int]:
    """Every element's hash, odd where only the share of a host's pages decides, even where ENOUGH_PAGES are enough."""
    return [
        e.digest | 1 if e.article or e.tag not in FURNITURE and e.words < ENOUGH_WORDS else e.digest & ~1 for e in page.elements
    ]


def subtree_hashes(page: Page) -> list[int]:
    """Keys of the candidates, as signed 64-bit integers, each once."""
    return sorted({k for k, may in zip(keys(page), candidates(page)) if may})


def segments(page: Page) -> tuple[list[str], list[tuple[int, int, int]]]:
    """What the rules leave of the page: runs of text, and (hash, first run, run after the last) of the candidates around them.

    Where ``main`` holds text, only that counts, else where ``article`` does, else everything. A run
    ends where a candidate begins or ends, so a candidate holds whole runs, one after the other.
    """
    count = len(page.elements)
    may = candidates(page)
    gone, region, home = [False] * count, [0] * count, [-1] * count
    for k, e in enumerate(page.elements):
        above = max(e.parent, 0)
        gone[k] = e.dropped or gone[above]
        region[k] = max(region[above], 2 if e.tag == "main" else int(e.article))
        home[k] = k if may[k] else home[above]
    inked = [region[k] for k, words, _ in page.texts if not gone[k] and not words.isspace()]
    best = max(inked, default=0)
    found: list[tuple[list[str], int]] = []
    begins = True
    for k, words, fresh in page.texts:
        begins |= fresh
        if gone[k] or region[k] < best:
            begins = True
            continue
        if not found or found[-1][1] != home[k]:
            found.append(([], home[k]))
        found[-1][0].append(" " + words if begins else words)
        begins = False
    joined = [(" ".join("".join(pieces).split()), k) for pieces, k in found]
    kept = [(text, k) for text, k in joined if text]
    first, end = [len(kept)] * count, [0] * count
    for at, (_, k) in enumerate(kept):
        if k >= 0:
            first[k], end[k] = min(first[k], at), at + 1
    for k in range(count - 1, 0, -1):  # an element comes after the one around it
        above = page.elements[k].parent
        first[above], end[above] = min(first[above], first[k]), max(end[above], end[k])
    key = keys(page)
    return [text for text, _ in kept], [(key[k], first[k], end[k]) for k in range(count) if may[k] and first[k] < end[k]]


def without_template(texts: list[str], template: list[tuple[int, int, bool]]) -> list[str]:
    """The runs that lie in no (first, end, whether on the stated share of the host's pages) of the template.

    What is on that share of pages is cut first, then what is on a few pages. What holds most of the
    running text that is there, that is of the runs of ``ENOUGH_WORDS`` and more, is the page's story
    and stays however often it recurs; only shorter runs are cut then. If all would go, all stays.
    """
    words = [len(text.split()) for text in texts]
    left = set(range(len(texts)))
    for wide in (True, False):
        change = [0] * (len(texts) + 1)
        for first, end, on_share in template:
            if on_share == wide:
                change[first] += 1
                change[end] -= 1
        gone = {k for k, inside in enumerate(accumulate(change[:-1])) if inside > 0} & left
        running = {k for k in left if words[k] >= ENOUGH_WORDS}
        if 2 * sum(words[k] for k in gone & running) > sum(words[k] for k in running):
            gone -= running
        left -= gone
    return [texts[k] for k in sorted(left)] or texts


PAGE_SCHEMA = (
    "page_id bigint, url string, host string, segments array<string>, blocks array<struct<hash:bigint,first:int,end:int>>, hashes array<bigint>"
)
_BLOCKS = pa.list_(pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32())]))


def parse_pages(pages: DataFrame) -> DataFrame:
    """Every page's runs of text, the candidates around them and the hashes of its other candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            parsed = [parse(h or "") for h in batch["html"].to_pylist()]
            cut = [segments(p) for p in parsed]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch["page_id"],
                "url": batch["url"],
                "host": pa.array([host_of(u) for u in batch["url"].to_pylist()], pa.string()),
                "segments": pa.array([texts for texts, _ in cut], pa.list_(pa.string())),
                "blocks": pa.array([[dict(zip(("hash", "first", "end"), b)) for b in blocks] for _, blocks in cut], _BLOCKS),
                # those that the blocks don't show already
                "hashes": pa.array([
                    sorted({*subtree_hashes(p)}.difference(b[0] for b in blocks)) for p, (_, blocks) in zip(parsed, cut)
                ], pa.list_(pa.int64())),
            })

    return pages.select("page_id", "url", "html").mapInArrow(run, PAGE_SCHEMA)


def site_templates(parsed: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, hash, wide) of what recurs on enough of a host's pages, and whether on the share of them. Hashes are counted before they are shuffled."""
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    on_page = F.array_union("hashes", F.transform("blocks", lambda b: b["hash"]))
    counted = parsed.select("host", F.explode(on_page).alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("on"))
    enough = F.col("hash").bitwiseAND(F.lit(1)).eqNullSafe(0) & (F.col("on") >= max(ENOUGH_PAGES, least_pages))
    recurring = counted.where(F.col("on") >= least_pages).join(sizes, "host")
    wide = F.col("on") >= least_share * F.col("pages")
    return recurring.where(enough | wide).select("host", "hash", wide.alias("wide"))


def extract_pages(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null html counts as empty and gives an empty text. Pages whose address has no host form
    one host. Repeated rows are pages of their own. Other columns are not read. What holds most
    of a page's running text stays, see ``without_template``.

    Pages are parsed once. The candidates around the text of a page meet the hashes that recur on its
    host, in a join on host and hash that adaptive execution splits for a hot one; a page gets back
    only places of its own, so no list grows with the host. Pages with no candidate around their text take no part.
    """
    parsed = staged(parse_pages(pages).withColumn("row", F.monotonically_increasing_id()), "page-segments")
    template = (
        parsed.select("row", "host", F.inline("blocks")).join(site_templates(parsed, least_pages, least_share), ["host", "hash"])
        .groupBy("row").agg(F.collect_list(F.struct("first", "end", "wide")).alias("template"))
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            cut = zip(batch["segments"].to_pylist(), batch["template"].to_pylist())
            left = [" ".join(without_template(texts, [(t["first"], t["end"], t["wide"]) for t in template or ()])) for texts, template in cut]
            yield pa.RecordBatch.from_pydict({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(left, pa.string())})

    is_open = F.size("blocks") > 0  # whether anything around the text may be template
    met = parsed.where(is_open).select("row", "page_id", "url", "segments").join(template, "row", "left")
    cleaned = met.select("page_id", "url", "segments", "template").mapInArrow(clean, "page_id bigint, url string, text string")
    done = parsed.where(~is_open).select("page_id", "url", F.array_join("segments", " ").alias("text"))
    return done.unionByName(cleaned).withColumn("n_chars", F.length("text").cast("bigint"))
