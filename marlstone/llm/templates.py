"""Main text of web pages by template deduction.

A token is an element that may hold others, as the path of tags and classes that
leads to it, or a block: the path of any element and the words that stand in it
without a break.  Its occurrence vector counts it on every page of a host.  Tokens with equal vectors
form an equivalence class; they came from the same part of the site's template.
Classes that most pages have and whose tokens stand once on a page are valid, and
are nested by their paths into the host's template.  What the template leaves
open are its slots: the one that holds the text is extracted, without the blocks
inside it that most pages of the host have alike.  Slots that are menus, forms,
adverts, comments and the like are known by fixed lists of tags, roles and words.

A page that would lose more than half of its text to blocks of the template is a
copy of others rather than made from the same template, and keeps them.

Vectors are never collected: a class is recognised by sums of hashes of page and
count, which tasks add up before anything is shuffled.  A host with a third of
all pages is a few sums like any other.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, written

#: Fixed values of HTML: elements without content, with content that is no markup, within a line, and containers.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math select button object audio video canvas".split())
NESTED = frozenset("svg math object template".split())  # of RAW, those that may hold another of their kind
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var".split()
)
CONTAINERS = frozenset("article main section div body td center blockquote".split())

#: Elements, roles and words of classes and ids that mark what is not the text.
APART = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion sidebar menu
    nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist
    respond reply replies discussion disqus footer masthead topbar toolbar search searchbox widget pagination pager
    skip""".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BLOCK = re.compile(
    r"</?(?:article|main|section|div|body|html|td|tr|th|table|center|blockquote|p|h[1-6]|ul|ol|li|dl|dt|dd|pre|figure|header|footer|nav|aside|form|hr)(?![\w-])", re.I
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAG = re.compile(r"[a-z][a-z0-9]*")


def _element(tag: str, rest: str) -> tuple[str, bool]:
    """The step an element adds to the path, and whether it is marked as standing apart from the text."""
    if "=" not in rest:
        return tag, tag in APART
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    classes = sorted(set(found.get("class", "").split()))
    words = {w.lower() for w in _WORD.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    apart = tag in APART or found.get("role", "").lower() in ROLES or not words.isdisjoint(MARKS)
    return ".".join([tag, *classes]), apart


def _raw_end(page: str, at: int, tag: str, parent: str) -> int:
    """Where the element of RAW whose start tag ends at ``at`` ends.

    Without an end tag of its own before the parent ends or, if such elements do not nest, the next one begins, it is
    unclosed: a script or style then takes the rest of the page, another ends where the next block begins or ends.
    """
    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
    if tag in ("script", "style"):
        return end.end() if end else len(page)
    if end:
        within, outside = 0, 0
        for m in re.compile(rf"<(/?)({re.escape(tag)}|{re.escape(parent) or tag})(?![\w-])[^>]*>", re.I).finditer(page, at):
            if m[2].lower() != tag:
                outside += -1 if m[1] else 1
                if outside < 0:
                    break
            elif not m[1]:
                if tag not in NESTED:
                    break
                within += not m[0].endswith("/>")
            elif within:
                within -= 1
            else:
                return m.end()
    block = _BLOCK.search(page, at)
    return block.start() if block else len(page)


def walk(page: str) -> list[tuple[str, str, bool, bool, str]]:
    """Events of a page: (kind, path, apart, linked, text) with kind open, close or text.

    Like a browser, a new block ends an open paragraph and what is open within its line, and a missing end tag is
    put in where an outer element ends.  What is inside a marked element stands apart from the text, unless the element
    wraps the page's article or main element or, on a page without one, most of its text.
    """
    size: dict[int, int] = {}  # text inside the marked elements and the articles, by number
    marked: dict[int, bool] = {}  # whether a marked element may wrap an article
    articles: dict[int, tuple[int, ...]] = {}  # the marked elements around each article
    events, total = [], 0
    for kind, path, around, linked, text in _events(page, marked, articles):
        events.append((kind, path, around, linked, text))
        if kind == "text" and not linked and (marked or articles):
            n = len(text.strip())
            for i in around:
                size[i] = size.get(i, 0) + n
        if kind == "text" and not linked:
            total += len(text.strip())
    if not marked:
        return [(kind, path, False, linked, text) for kind, path, _, linked, text in events]
    clear = max((size.get(i, 0) for i, over in articles.items() if not over), default=0)
    held = [i for i, over in articles.items() if over and size.get(i, 0) > 2 * clear and all(marked[o] for o in over)]
    if held:
        spared = set(articles[max(held, key=lambda i: size[i])])
    else:
        spared = {i for i in marked if not clear and 2 * size.get(i, 0) > total}
    apart = marked.keys() - spared
    return [(kind, path, not apart.isdisjoint(around), linked, text) for kind, path, around, linked, text in events]


def _events(page: str, marked: dict[int, bool], articles: dict[int, tuple[int, ...]]) -> Iterator[tuple[str, str, tuple[int, ...], bool, str]]:
    """Events with the numbers of the marked elements and articles around them, which are entered in the two tables."""
    stack: list[tuple[str, str, tuple[int, ...], bool]] = []  # tag, path, around, linked
    at, raw = 0, None
    path, apart, linked = "", (), False
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at and raw is None:
            yield "text", path, apart, linked, page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if not m[1]:
            if tag in RAW:
                if not m[3].endswith("/"):
                    at = _raw_end(page, at, tag, next((t for t, *_ in reversed(stack) if t not in INLINE), ""))
                continue
            if tag in VOID:
                yield ("text", path, apart, linked, " ") if tag in ("br", "wbr", "img") else ("open", path, apart, linked, "")
                continue
            if not _TAG.fullmatch(tag):
                continue
            if tag not in INLINE:
                while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option")):
                    yield "close", stack[-1][1], stack[-1][2], stack[-1][3], stack[-1][0]
                    stack.pop()
                path, apart, linked = stack[-1][1:] if stack else ("", (), False)
            step, own = _element(tag, m[3])
            if tag in ("article", "main") and not own:
                number = len(marked) + len(articles)
                articles[number] = tuple(i for i in apart if i in marked)
                apart = (*apart, number)
            own = own and tag not in ("body", "html", "article", "main")
            if tag not in INLINE or own:
                path = f"{path}>{step}" if path else step
            if own:
                number = len(marked) + len(articles)
                marked[number] = tag == "form" or tag not in APART
                apart = (*apart, number)
            linked = linked or tag == "a"
            stack.append((tag, path, apart, linked))
            yield "open", path, apart, linked, tag
        else:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is None or (tag in INLINE or tag == "p") and any(t not in INLINE and t != tag for t, *_ in stack[depth + 1 :]):
                continue
            while len(stack) > depth:
                yield "close", stack[-1][1], stack[-1][2], stack[-1][3], stack[-1][0]
                stack.pop()
            path, apart, linked = stack[-1][1:] if stack else ("", (), False)
    if at < len(page):
        yield "text", path, apart, linked, page[at:]


Events = list[tuple[str, str, bool, bool, str]]


def measure(events: Events) -> dict[str, list[int]]:
    """Tokens of a page that may contain others: how often they occur and how much text of their own they hold."""
    found: dict[str, list[int]] = {}
    for kind, path, apart, linked, text in events:
        if kind == "open" and text in CONTAINERS and not apart:
            found.setdefault(path, [0, 0])[0] += 1
        elif kind == "text" and not apart and not linked:
            n = len(text)
            while path:
                if path in found:
                    found[path][1] += n
                path = path.rpartition(">")[0]
    return found


def choose(tokens: dict[str, int]) -> str | None:
    """The token that holds the text, of those of a template with the amounts of text under them.

    An article or main element with half of the text, else the innermost container with most of it.
    """
    if not tokens:
        return None
    most = max(tokens.values())
    named = [t for t, n in tokens.items() if 2 * n >= most and t.rpartition(">")[2].split(".")[0] in ("article", "main")]
    wide = named or [t for t, n in tokens.items() if 5 * n >= 4 * most]
    return max(wide, key=lambda t: (t.count(">"), tokens[t], t))


def lines(events: Events) -> list[tuple[str, str]]:
    """Blocks of a page in its order, without those apart from the text: path and words."""
    found, block, at = [], [], ""

    def end() -> None:
        if line := " ".join(html.unescape("".join(block)).split()):
            found.append((at, line))
        block.clear()

    for kind, path, apart, _, text in events:
        if kind == "text":
            if not apart:
                at = path
                block.append(text)
        elif text not in INLINE and block:
            end()
    end()
    return found


def block_token(path: str, line: str) -> str:
    return f"{path}\n{xxhash.xxh3_64_hexdigest(f'{path}\n{line}')}"


def extract(page: str, main: str | None, fixed: frozenset[str] = frozenset()) -> str:
    """Text under the token ``main``: blocks in page order, one a line; the page's own choice if it has no such token.

    Blocks whose tokens are ``fixed`` are left out, unless that is most of the text.
    """
    events = walk(page)
    found = measure(events)
    if main not in found:
        main = choose({t: n for t, (times, n) in found.items() if times == 1}) or choose({t: n for t, (_, n) in found.items()})
    under = f"{main}>" if main else ""
    inside = [(path, line) for path, line in lines(events) if path == main or path.startswith(under)]
    if fixed:
        kept = [(path, line) for path, line in inside if block_token(path, line) not in fixed]
        if 2 * sum(len(line) for _, line in kept) >= sum(len(line) for _, line in inside):
            inside = kept
    return "\n".join(line for _, line in inside)


MIN_PAGES = 4  # with fewer pages, what they have in common says nothing about a template
HOST = r"(?s)^.*?://([^/?#]*)"
SUMS = "host string, token string, pages long, once long, chars long, low long, high long"


def _token_sums(pages: DataFrame) -> DataFrame:
    """Partial sums of the occurrence vectors of (host, token); the empty token counts the pages of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], list[int]] = {}

        def flush() -> pa.RecordBatch:
            columns = list(zip(*((*k, *v) for k, v in sums.items()), strict=True))
            sums.clear()
            kinds = [pa.string(), pa.string()] + [pa.int64()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in SUMS.split(", ")]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    events = walk(r["html"] or "")
                    found = measure(events)
                    found[""] = [1, 0]
                    for path, line in lines(events):
                        f = found.setdefault(block_token(path, line), [0, 0])
                        f[0] += 1
                        f[1] += len(line)
                    for token, (times, chars) in found.items():
                        s = sums.setdefault((r["host"], token), [0, 0, 0, 0, 0])
                        h = xxhash.xxh64_intdigest(f"{r['row']}:{times}")
                        for i, v in enumerate((1, times == 1, chars, h & 0xFFFFFFFF, h >> 32)):
                            s[i] += v
                if len(sums) > 50_000:
                    yield flush()
        if sums:
            yield flush()

    return pages.select("host", "html", "row").mapInArrow(run, SUMS)


def _is_block(token: str) -> Column:
    return F.col(token).contains("\n")


def deduce(pages: DataFrame, min_share: float = 0.5) -> DataFrame:
    """One row for each host and valid class: host, class_id, parent_id, pages and tokens with their amounts of text."""
    numbers = ("pages", "once", "chars", "low", "high")
    tokens = _token_sums(pages).groupBy("host", "token").agg(*[F.sum(n).alias(n) for n in numbers])
    tokens = written(tokens.filter(~_is_block("token") | (F.col("pages") >= MIN_PAGES)), "tokens")
    hosts = tokens.filter("token = ''").select("host", F.col("pages").alias("host_pages"))
    frequent = tokens.filter("token <> ''").join(hosts, "host").filter(F.col("pages") >= min_share * F.col("host_pages"))
    classes = (
        # Elements that repeat on a page are inside slots; blocks that do are still the template's.
        frequent.filter((F.col("once") == F.col("pages")) | _is_block("token"))
        .groupBy("host", "pages", "low", "high")
        .agg(F.array_sort(F.collect_list(F.struct(F.length("token").alias("n"), "token", "chars"))).alias("tokens"))
        .withColumn("class_id", F.xxhash64("host", "low", "high"))
    )
    classes = written(classes.select("host", "class_id", "pages", F.transform("tokens", lambda t: F.struct(t["token"].alias("token"), t["chars"].alias("chars"))).alias("tokens")), "classes")
    # A class is nested in the one that holds the nearest token above its first.
    outer = classes.select("host", F.col("class_id").alias("parent_id"), F.explode("tokens").alias("outer"))
    inner = classes.select("host", "class_id", F.col("tokens")[0]["token"].alias("first"))
    parents = (
        inner.join(outer, "host")
        .filter((F.col("class_id") != F.col("parent_id")) & F.col("first").startswith(F.concat("outer.token", F.lit(">"))))
        .groupBy("host", "class_id")
        .agg(F.max_by("parent_id", F.length("outer.token")).alias("parent_id"))
    )
    return classes.join(parents, ["host", "class_id"], "left")


def main_tokens(template: DataFrame) -> DataFrame:
    """host and the token of its template that holds the text."""
    tokens = template.select("host", F.explode("tokens").alias("t")).select("host", "t.*").filter(~_is_block("token"))
    most = tokens.groupBy("host").agg(F.max("chars").alias("most"))
    tag = F.element_at(F.split(F.element_at(F.split("token", ">"), -1), r"\."), 1)
    named = tag.isin("article", "main") & (2 * F.col("chars") >= F.col("most"))
    wide = 5 * F.col("chars") >= 4 * F.col("most")
    rank = F.struct(named, F.size(F.split("token", ">")), F.col("chars"), F.col("token"))
    return tokens.join(most, "host").filter(named | wide).groupBy("host").agg(F.max_by("token", rank).alias("main"))


def fixed_blocks(template: DataFrame) -> DataFrame:
    """host and the tokens of the blocks that its template holds; no more than twice the blocks of a page on average."""
    tokens = template.select("host", F.explode("tokens.token").alias("token")).filter(_is_block("token"))
    return tokens.groupBy("host").agg(F.collect_list("token").alias("fixed"))


def main_text(pages: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Main text of every page of ``pages`` (page_id, url, html).

    Returns page_id, url, text and n_chars, a row for every input row.  Blocks that ``min_share`` of the pages of a host,
    and at least four, have at the same place are its template's and not part of the text.  Character references are decoded, white space
    inside a block becomes one space, blocks are joined by line breaks.  A null or empty html gives an empty text.
    Pages whose url is null or has no host share a template.  Page_ids may be null or repeat; further columns are not
    read; an empty table gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    template = written(deduce(rows.withColumn("row", F.monotonically_increasing_id()), min_share), "template")
    mains = main_tokens(template).join(fixed_blocks(template), "host", "full")
    mains = broadcast_if_small(written(mains, "main-tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                given = zip(*(part.column(c).to_pylist() for c in (2, 3, 4)), strict=True)
                texts = [extract(p or "", m, frozenset(f or ())) for p, m, f in given]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    joined = rows.join(mains, "host", "left").select("page_id", "url", "html", "main", "fixed")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
