"""The main text of web pages, with each site's template removed.

Every block element's subtree is hashed in two ways: its text and markup, and its
slot, that is, the tags and names from the root down to it and whether it is made
of links. Spark counts both, per host and per section of a host, over different
pages. A subtree that recurs with its text is template. So is a slot that most
pages have, such as a menu whose links differ, unless it holds, is or lies in the
slot where most of the text is, which is different on each page.

What counts cannot tell, they leave to what elements say of themselves (tag, class,
id, role): menus and adverts of hosts with too few pages, and whatever stands
within the article itself, such as the readers' comments.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.bpe import slices
from wardframe.llm.common import quoted, stored
from wardframe.llm.url_graph import host_of, path_of
from wardframe.llm.worker import serve

# A subtree is template if it is on so many different pages of its host, and on
# this share of them. Within the article the share is high: a sentence that
# several articles of a site have in common is still theirs.
MIN_PAGES = 5
OUTER_SHARE = 0.2
INNER_SHARE = 0.6
# A slot outside the text is template on this share of the pages; the text is the
# innermost slot with this share of the characters.
SLOT_SHARE = 0.5
TEXT_SHARE = 0.5
# Blocks that hold a text, as opposed to its headings, paragraphs and lists.
HOLDERS = frozenset("article body center div html main section td".split())
LINKED_SHARE = 0.6

# Element kinds of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea noscript iframe template svg math xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr"
    " ul".split()
)
# What an opening tag closes when it is still open, up to the named scopes.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEEPS_P_OPEN = frozenset(
    "body html option optgroup caption tbody td tfoot th thead tr".split()
)

# What is never article text, by tag, by role, and by words of class and id.
DROPPED_TAGS = frozenset(
    "aside button canvas datalist dialog embed footer form head input label map menu nav object"
    " select script style noscript template iframe svg math textarea title audio video".split()
)
DROPPED_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search"
    " toolbar".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert alert adverts advertisement advertising adsense adslot banner breadcrumb"
    " breadcrumbs comment comments commentlist consent cookie cookies copyright dialog discussion"
    " disclaimer disqus feedback footer gdpr masthead menu menus modal nav navbar navigation"
    " newsletter notice"
    " notices notification overlay pager pagination paywall popup promo promoted promotion"
    " related reactions recommended replies reply respond responses rss search share sharing"
    " sidebar sidebars signup"
    " skip social sponsor sponsored subscribe subscription teaser toolbar topbar tracking widget"
    " widgets".split()
)
# Dropped unless the same name speaks of the content, as in "entry-header".
WEAK_WORDS = frozenset(["header"])
CONTENT_WORDS = frozenset("article content entry post story text body main".split())
MAIN_TAGS = frozenset(["article", "main"])

TAG = re.compile(
    r"<!--(?:.*?--!?>|-?>|.*\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|</?[A-Za-z][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(
    r"(?:^|[\s\"'/])(class|id|role|hidden|style|aria-hidden)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)",
    re.I,
)
NAMES = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
DIGITS = re.compile(r"[0-9]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
LETTERS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """A page's elements in order of their start; parents come before children."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    own_drop: list[bool] = field(default_factory=list)
    is_main: list[bool] = field(default_factory=list)
    under_main: list[bool] = field(default_factory=list)
    digest: list[int] = field(default_factory=list)
    names: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    has_core: list[bool] = field(default_factory=list)
    # (element, text), or (element, None) where a block starts or ends
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _marked(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element says it is no article text, only weakly so, or the main part."""
    if not attributes.strip():
        return False, False, False
    drop = weak = main = False
    words: set[str] = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            words.update(w.lower() for w in WORD.findall(value))
            words.update(LETTERS.findall(value.lower()))
        elif name == "role":
            drop |= value.lower() in DROPPED_ROLES
            main |= value.lower() == "main"
        elif name == "style":
            drop |= bool(HIDDEN_STYLE.search(value))
        elif name == "hidden":
            drop = True
        elif name == "aria-hidden":
            drop |= value.lower() == "true"
    drop |= bool(words & DROPPED_WORDS)
    weak = bool(words & WEAK_WORDS) and not words & CONTENT_WORDS
    return drop, weak, main


def parse(source: str) -> Page:
    """The elements and texts of a page, in one pass and without recursion."""
    import xxhash

    page = Page()
    stack: list[int] = []
    content: list[list[str]] = []  # per open element, what its digest is made of

    def open_element(tag: str, attributes: str) -> None:
        own, weak, main = _marked(tag, attributes)
        parent = stack[-1] if stack else -1
        main = main or tag in MAIN_TAGS
        in_main = parent >= 0 and page.under_main[parent]
        own = own or tag in DROPPED_TAGS or (not in_main and (weak or tag == "header"))
        page.tag.append(tag)
        page.parent.append(parent)
        page.own_drop.append(own and tag not in ("html", "body"))
        page.is_main.append(main)
        page.under_main.append(main or in_main)
        page.digest.append(0)
        named = DIGITS.sub("0", "\x01".join(map("".join, NAMES.findall(attributes)))) if attributes else ""
        path = page.names[parent] if parent >= 0 else 0
        page.names.append(xxhash.xxh64_intdigest(f"{path:x} {tag} {named}"))
        page.chars.append(0)
        page.linked.append(0)
        page.links.append(1 if tag == "a" else 0)
        page.has_core.append(tag == "h1")
        stack.append(len(page.tag) - 1)
        content.append([tag])

    def close_element() -> None:
        i, parts = stack.pop(), content.pop()
        page.digest[i] = xxhash.xxh64_intdigest("\x00".join(parts)) >> 2
        if page.tag[i] == "a":
            page.linked[i] = page.chars[i]
        up = page.parent[i]
        if up >= 0:
            page.chars[up] += page.chars[i]
            page.linked[up] += page.linked[i]
            page.links[up] += page.links[i]
            content[-1].append(f"{page.digest[i]:x}")

    def end_block() -> None:
        page.pieces.append((stack[-1] if stack else -1, None))

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            if page.tag[stack[-1]] in BLOCKS:
                end_block()
            close_element()

    def close_open(tags: set[str], scopes: set[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            tag = page.tag[stack[depth]]
            if tag in tags:
                return close_to(depth)
            if tag in scopes:
                return None

    def text(raw: str) -> None:
        if not raw:
            return
        plain = entities.unescape(raw) if "&" in raw else raw
        page.pieces.append((stack[-1] if stack else -1, plain))
        bare = SPACE.sub(" ", plain).strip()
        if bare and stack:
            page.chars[stack[-1]] += len(bare)
            content[-1].append(bare)

    at, size = 0, len(source)
    while at < size:
        found = TAG.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        closing = bool(found[1] or found[4])
        tag, attributes = name.lower(), (found[3] if found[2] else found[6]) or ""
        if closing:
            if tag == "br":
                text(" ")
            for depth in range(len(stack) - 1, -1, -1):
                if page.tag[stack[depth]] == tag:
                    close_to(depth)
                    break
            continue
        if tag in BLOCKS:
            if tag not in KEEPS_P_OPEN:
                close_open({"p"}, {"table", "td", "th", "button", "caption"})
            if tag in CLOSES:
                close_open(*CLOSES[tag])
            if tag in ("html", "body") and any(page.tag[i] == tag for i in stack):
                continue
            end_block()
        elif tag == "option":
            close_open(*CLOSES[tag])
        if tag in VOID:
            text(" ") if tag in ("br", "hr") else None
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
            continue
        open_element(tag, attributes)
        if attributes.rstrip().endswith("/") and tag not in BLOCKS and tag != "a":
            close_to(len(stack) - 1)
    close_to(0)
    _mark_core(page)
    return page


def _mark_core(page: Page) -> None:
    """Marks what holds the article: headline and largest main element, with all around them.

    Teasers and comments may be article elements too, so one of them is no reason
    to spare the list it is in.
    """
    mains = [i for i, main in enumerate(page.is_main) if main and not page.own_drop[i]]
    if mains:
        page.has_core[max(mains, key=lambda i: page.chars[i])] = True
    for i in range(len(page.tag) - 1, -1, -1):
        if page.has_core[i] and page.parent[i] >= 0:
            page.has_core[page.parent[i]] = True


def _dropped(page: Page) -> list[bool]:
    """Elements that are, or lie in, something that is no article text by its own word.

    An element is spared if the article itself is in it.
    """
    gone: list[bool] = []
    for i, parent in enumerate(page.parent):
        own = page.own_drop[i] and not (page.has_core[i] and page.tag[i] not in DROPPED_TAGS)
        gone.append(own or (parent >= 0 and gone[parent]))
    return gone


def _inside(page: Page, gone: list[bool]) -> list[bool]:
    """Elements of the article: of article elements and headlines beside them, else of a main one."""
    written = any(
        tag == "article" and page.chars[i] and not gone[i] for i, tag in enumerate(page.tag)
    )
    inside: list[bool] = []
    for i, parent in enumerate(page.parent):
        if written:
            starts = page.tag[i] == "article" or (page.tag[i] == "h1" and page.under_main[i])
        else:
            starts = page.is_main[i]
        inside.append((starts and not gone[i]) or (parent >= 0 and inside[parent]))
    return inside


def slot(page: Page, i: int) -> int:
    """The mark of an element's slot; below zero, unlike those of subtrees."""
    linked = page.linked[i] > LINKED_SHARE * page.chars[i]
    return -((page.names[i] >> 2) * 2 + linked) - 1


def marks(page: Page) -> dict[int, tuple[int, int]]:
    """Marks of subtrees and slots of the page's blocks with text: (characters, digest of the text).

    The lowest bit of a subtree's mark says whether it is in the article.
    """
    inside = _inside(page, _dropped(page))
    found: dict[int, tuple[int, int]] = {}
    for i, tag in enumerate(page.tag):
        if tag in BLOCKS and page.chars[i]:
            if not page.has_core[i]:
                found[page.digest[i] * 2 + inside[i]] = page.chars[i], 0
            own = slot(page, i)
            chars, digest = found.get(own, (0, 0))
            found[own] = chars + page.chars[i], digest ^ page.digest[i]
    return found


def depths(page: Page) -> dict[int, int]:
    """How deep each slot lies; below zero if it holds no other blocks by its kind."""
    level: list[int] = []
    for parent in page.parent:
        level.append(level[parent] + 1 if parent >= 0 else 0)
    return {slot(page, i): level[i] if tag in HOLDERS else -1 for i, tag in enumerate(page.tag)}


def _protected(page: Page, content: set[int]) -> list[bool]:
    """Elements that are, hold, or lie in, the slots of the text."""
    own = [slot(page, i) in content for i in range(len(page.tag))]
    under: list[bool] = []
    for i, parent in enumerate(page.parent):
        under.append(own[i] or (parent >= 0 and under[parent]))
    for i in range(len(own) - 1, -1, -1):
        if own[i] and page.parent[i] >= 0:
            own[page.parent[i]] = True
    return [a or b for a, b in zip(own, under)]


def main_text(page: Page, template: set[int], content: set[int] = frozenset()) -> str:
    """The text of the article's blocks, one line each."""
    gone = _dropped(page)
    inside = _inside(page, gone)
    spared = _protected(page, content) if content else [True] * len(gone)
    for i, parent in enumerate(page.parent):
        block = page.tag[i] in BLOCKS
        recurs = block and page.digest[i] * 2 + inside[i] in template
        recurs = recurs or (block and not inside[i] and not spared[i] and slot(page, i) in template)
        menu = (
            not inside[i]
            and not page.has_core[i]
            and block
            and page.links[i] > 1
            and page.linked[i] > LINKED_SHARE * page.chars[i]
        )
        above = parent >= 0 and gone[parent]
        gone[i] = gone[i] or above or (recurs and not page.has_core[i]) or menu

    def lines(only_main: bool) -> list[str]:
        found, block = [], []
        for element, piece in [*page.pieces, (-1, None)]:
            if piece is None:
                line = SPACE.sub(" ", "".join(block)).strip()
                if line:
                    found.append(line)
                block = []
            elif element < 0 or not gone[element]:
                if not only_main or (element >= 0 and inside[element]):
                    block.append(piece)
        return found

    return "\n".join(lines(True) or lines(False))


COUNTED = "scope string, version long, mark long, chars long, digest long, depth int"


def _mark_batches(batches) -> Iterator[pa.RecordBatch]:
    """The marks of each page, for its host and for its section; mark 0 is the page."""
    import xxhash

    serve("html")
    for batch in batches:
        for a, b in slices(batch.column(2)):
            scopes, versions, found, chars, digests, depth = [], [], [], [], [], []
            part = batch.slice(a, b - a)
            for host, section, source in zip(*[c.to_pylist() for c in part.columns]):
                page = parse(source)
                whole = "\x00".join(t for _, t in page.pieces if t)
                version = xxhash.xxh64_intdigest(whole) >> 1
                top = sum(page.chars[i] for i, parent in enumerate(page.parent) if parent < 0)
                own, deep = {0: (top, 0), **marks(page)}, depths(page)
                # Within an article the few pages of a section may well share a common sentence.
                outside = {m: n for m, n in own.items() if m <= 0 or m % 2 == 0}
                for scope, counted in ((host, own), (section, outside)):
                    scopes += [scope] * len(counted)
                    versions += [version] * len(counted)
                    found += counted.keys()
                    chars += [n for n, _ in counted.values()]
                    digests += [d for _, d in counted.values()]
                    depth += [deep.get(m, 0) for m in counted]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            columns = [pa.array(*c) for c in zip((scopes, versions, found, chars, digests, depth), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COUNTED.split(", ")])


def _sections(url: Column) -> Column:
    """Host and first part of the path; a scope of its own beside the host."""
    return F.concat(host_of(url), F.lit("/"), F.regexp_extract(path_of(url), "^/([^/]*)/", 1))


def site_templates(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    outer_share: float = OUTER_SHARE,
    inner_share: float = INNER_SHARE,
    url_col: str = "url",
    html_col: str = "html",
    slot_share: float = SLOT_SHARE,
) -> DataFrame:
    """Rows (scope, marks, content): what recurs across the pages of a host, or of a section of it.

    ``marks`` are subtrees and slots of the template; ``content`` is the innermost
    slot with most of the text, different from page to page, which no slot of the
    template deletes. Pages with
    the same text count once, so that copies of an article do not make it a
    template. Counts are merged in every task before the shuffle. A scope has at
    most 1 / share times the marks of its largest page.
    """
    url = quoted(url_col)
    marked = (
        pages.select(host_of(url).alias("host"), _sections(url).alias("section"), quoted(html_col).alias("html"))
        .filter("host <> '' AND html IS NOT NULL")
        .mapInArrow(_mark_batches, COUNTED)
    )
    # One row per page and mark: copies of a page are one from here on.
    once = marked.groupBy("scope", "mark", "version").agg(*[F.max(c).alias(c) for c in ("chars", "digest", "depth")])
    counts = once.groupBy("scope", "mark").agg(
        F.count("*").alias("n"),
        F.sum("chars").alias("chars"),
        F.max("depth").alias("depth"),
        (F.min("digest") != F.max("digest")).alias("differs"),
    )
    often = stored(counts.filter(F.col("n") >= min_pages), "subtrees")
    totals = often.filter("mark = 0").select("scope", F.col("n").alias("total"), F.col("chars").alias("all_chars"))
    share = (
        F.when(F.col("mark") < 0, slot_share).when(F.col("mark") % 2 == 1, inner_share).otherwise(outer_share)
    )
    recurs = F.col("n") >= share * F.col("total")
    texts = (F.col("mark") < 0) & (F.col("depth") >= 0) & F.col("differs") & (F.col("chars") >= TEXT_SHARE * F.col("all_chars"))
    deepest = F.max(F.when(texts, F.struct("depth", "mark")))
    return (
        often.filter("mark <> 0")
        .join(totals, "scope")
        .filter(recurs)
        .groupBy("scope")
        .agg(F.collect_list("mark").alias("marks"), deepest.alias("deepest"))
        .select("scope", "marks", F.col("deepest.mark").alias("content"))
    )


def _text_batches(names: list[str]):
    def run(batches):
        serve("html")
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = []
                for source, own, content in zip(*[part.column(i).to_pylist() for i in (1, 2, 3)]):
                    texts.append(main_text(parse(source or ""), set(own or ()), set(content or ())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(4), pa.array(texts, pa.string())], names=names
                )

    return run


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    outer_share: float = OUTER_SHARE,
    inner_share: float = INNER_SHARE,
    slot_share: float = SLOT_SHARE,
) -> DataFrame:
    """Rows (id, url, text), one per page row: the article without the site around it.

    Character references are decoded, white space within a block is one space,
    and blocks are joined by a line feed in page order. Without an article or
    main element all blocks count that are neither marked, nor template, nor
    menus of links. Null or empty html gives an empty text. A page without a
    host, or whose host has fewer than ``min_pages`` different pages, is cut by
    marks alone. Repeated rows come back as often; an empty table gives an
    empty table, and other columns are not looked at.
    """
    templates = stored(
        site_templates(pages, min_pages, outer_share, inner_share, url_col, html_col, slot_share), "templates"
    )
    rows = pages.select(
        quoted(id_col).alias("id"),
        quoted(html_col).alias("html"),
        quoted(url_col).alias("url"),
        host_of(quoted(url_col)).alias("host"),
        _sections(quoted(url_col)).alias("section"),
    )
    # The pages come first: a host with a third of them may then be split.
    for scope in ("host", "section"):
        own = templates.select(*[F.col(c).alias(f"{c}_of_{scope}") for c in templates.columns])
        rows = rows.join(own, F.col(scope) == F.col(f"scope_of_{scope}"), "left")
    none = F.array().cast("array<bigint>")
    either = F.concat(*[F.coalesce(f"marks_of_{s}", none) for s in ("host", "section")])
    content = F.array_compact(F.array("content_of_host", "content_of_section"))
    joined = rows.select("id", "html", either.alias("marks"), content.alias("content"), "url")
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField(url_col, T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    return joined.mapInArrow(_text_batches([id_col, url_col, "text"]), schema)
