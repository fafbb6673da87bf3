import re
from collections import Counter

import pytest

from wardframe.llm import html_text as H


def text_of(source, template=frozenset()):
    return H.main_text(H.parse(source), set(template))


ARTICLE = "<article><h1>Title</h1><p>One &amp; two.</p><p>Three<br>four</p></article>"
PLAIN = "Title\nOne & two.\nThree four"


@pytest.mark.parametrize(
    "around",
    [
        "{}",
        "<nav><ul><li><a href=/a>A</a></li></ul></nav>{}<footer>&copy; site</footer>",
        "<header><h2>Site</h2></header><div class=sidebar><p>Links</p></div>{}",
        "<div class='ad'>Buy</div>{}<section class=\"comments\"><p>First!</p></section>",
        "<div id=cookie-notice>We use cookies</div>{}<form><p>Mail</p><input></form>",
        "<script>var t='</p><p>x';</script><style>p{{}}</style>{}<!-- <p>no</p> -->",
        "<aside><p>Related</p></aside>{}<div role=navigation>Up</div><div hidden>h</div>",
        "<div class='page-with-sidebar'>{}</div>",
        "{}<section class=related><article><h3>Other</h3><p>A teaser</p></article></section>",
        "<main>{}<ol class='commentlist'><li><article class='comment'><p>Hm</p></article></ol></main>",
        "<div class='advertisement'><p>x</p></div>{}<div class=newsletterBox>join</div>",
    ],
)
def test_what_is_around_the_article_goes(around):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around.format(ARTICLE)}</body></html>"
    assert text_of(page) == PLAIN


def test_main_around_an_article():
    page = "<main><div>Welcome</div><h1>Title</h1><article><p>One</p></article><div>Call us</div></main>"
    assert text_of(page) == "Title\nOne"
    assert text_of("<p>a</p><main><p>One</p></main><p>b</p>") == "One"


def test_what_is_inside_the_article_but_not_of_it():
    inside = "<div class=share>Share</div><div class='ad-slot'>Buy</div><div class='reader-comments'><p>Hm</p></div>"
    assert text_of(ARTICLE.replace("<p>Three", inside + "<p>Three")) == PLAIN


def test_without_an_article_blocks_count():
    page = (
        "<body><div class=menu><a href=1>a</a></div><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul>"
        "<div id=content><h1>Title</h1><p>One &amp; two.<p>Three\n four</div><div class=footer>End</div>"
    )
    assert text_of(page) == PLAIN


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<p>a < b &lt; c &#233;&eacute; &am &nbsp; x</p>", "a < b < c éé &am x"),
        ("<p>un<b>bold</b>ed", "unbolded"),
        ("<article><p><b>One<br><p>Two</article>", "One\nTwo"),
        ("<article>a<div>b</div>c</article>", "a\nb\nc"),
        ("<p title='>'>x</p><p data-x=\"a>b\">y</p>", "x\ny"),
        ("<p>x</p><a href='broken", "x"),
        ("<p>x</p><!-- open", "x"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("</div></p>x</article>", "x"),
        ("<script>never closed <p>x</p>", ""),
    ],
)
def test_odd_markup(source, text):
    assert text_of(source) == text


def test_depth_and_length_are_no_matter():
    assert text_of("<div>" * 20_000 + "x") == "x"
    many = "".join(f"<p>word {i}</p>" for i in range(20_000))
    assert text_of(f"<article>{many}</article>").count("\n") == 19_999


def site(n, host):
    """Pages whose template says nothing of itself; one sentence is shared by some articles."""
    pages = []
    for i in range(n):
        shared = "<p>A shared line.</p>" if i % 3 == 0 else ""
        body = f"<div><p>Welcome to the site</p></div><h1>T{i}</h1><p>Text {i} of it.</p>{shared}<div>Call us now</div>"
        pages.append((len(pages), f"https://{host}/p/{i}", f"<body>{body}</body>"))
    return pages


def test_template_of_a_host_goes(spark):
    rows = site(30, "A.example.org") + [(99, "https://b.example.org/", site(1, "x")[0][2])]
    df = spark.createDataFrame([(i, *r[1:], "x") for i, r in enumerate(rows)], "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in H.extract_text(df, outer_share=0.5).collect()}
    for i in range(30):
        assert found[i] == "\n".join([f"T{i}", f"Text {i} of it.", *(["A shared line."] if i % 3 == 0 else [])])
    # A host with one page has no template to be seen.
    assert found[30] == "Welcome to the site\nT0\nText 0 of it.\nA shared line.\nCall us now"


def plain_templates(rows, min_pages=H.MIN_PAGES, slot_share=H.SLOT_SHARE):
    """{scope: (marks, content)}, page by page, by the rules as written."""
    pages = {}
    for _, url, source in rows:
        host = re.sub(r"(?s)^.*?://([^/?#]*).*$", r"\1", url).lower() if "://" in (url or "") else ""
        if not host or source is None:
            continue
        path = re.sub(r"(?s)^.*?://[^/?#]*([^?#]*).*$", r"\1", url)
        section = re.findall("^/([^/]*)/", path)
        page = H.parse(source)
        words = "\0".join(t for _, t in page.pieces if t)
        for scope in (host, f"{host}/{section[0] if section else ''}"):
            pages.setdefault(scope, {})[words] = page
    found = {}
    for scope, versions in pages.items():
        often, chars, deep, kinds, whole = Counter(), Counter(), {}, {}, 0
        for page in versions.values():
            own = H.marks(page)
            whole += sum(n for n, parent in zip(page.chars, page.parent) if parent < 0)
            often.update(m for m in own if m < 0 or m % 2 == 0 or "/" not in scope)
            chars.update({m: n for m, (n, _) in own.items()})
            for m, (_, digest) in own.items():
                kinds.setdefault(m, set()).add(digest)
            deep.update(H.depths(page))
        kept = set()
        for mark, n in often.items():
            share = slot_share if mark < 0 else H.INNER_SHARE if mark % 2 else H.OUTER_SHARE
            if n >= max(min_pages, share * len(versions)):
                kept.add(mark)
        texts = [(deep[m], m) for m in kept if m < 0 <= deep[m] and len(kinds[m]) > 1 and chars[m] >= H.TEXT_SHARE * whole]
        if kept:
            found[scope] = (kept, max(texts)[1] if texts else None)
    return found


def menus(i, n=6):
    links = "".join(f"<li><a href=/x{i}-{k}>Link {i} {k}</a></li>" for k in range(n))
    return f"<ul class=m{i}>{links}</ul>"


def unmarked(n, host, first=0):
    """Pages without any telling name: menu, teaser and end differ on each, as the text does."""
    for i in range(first, first + n):
        text = "".join(f"<p>Sentence {i} {k} of the text itself, which goes on.</p>" for k in range(5 + i % 7))
        yield (
            i,
            f"https://{host}/s/{i}",
            f"<body>{menus(i)}<div class=box><p>Look at offer {i}</p></div><h1>T{i}</h1>"
            f"<div class=x7><h2>Part {i}</h2>{text}<ul><li>Point {i}</li></ul></div><div class=end>Page {i}</div></body>",
        )


def test_slots_whose_text_differs_go_and_the_text_stays(spark):
    rows = [*unmarked(40, "a.example.org"), *unmarked(3, "b.example.org", 100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in H.extract_text(df).collect()}
    for i in range(40):
        lines = [f"Sentence {i} {k} of the text itself, which goes on." for k in range(5 + i % 7)]
        assert found[i].split("\n") == [f"T{i}", f"Part {i}", *lines, f"Point {i}"]
    # Three pages tell no slot from the text.
    assert "Look at offer 100" in found[100] and found[100].endswith("Page 100")


def test_a_block_of_one_section_goes_however_large_its_host(spark):
    rows = [
        (i, f"http://h.org/{'news' if i < 12 else f'part{i}'}/{i}", f"<body><p>Own words {i} {'and ' * 30}</p>{'<div>Section line</div>' if i < 12 else ''}</body>")
        for i in range(150)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in H.extract_text(df).collect()}
    assert not any("Section line" in t for t in found.values())
    assert all(found[i].startswith(f"Own words {i} ") for i in range(150))


def test_templates_equal_a_plain_count(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [*unmarked(20, "A.example.org"), *unmarked(20, "A.example.org"), *site(12, "c.org")]
    rows += [(1, None, "<p>x"), (2, "http://d.org/", None), (3, "no scheme", "<p>x"), (None, "http://e.org/a/b", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.scope: (set(r.marks), r.content) for r in H.site_templates(df).collect()}
    assert found == plain_templates(rows)
    want = sorted(
        (r[0] or 0, H.main_text(H.parse(r[2] or ""), *chosen(found, r[1]))) for r in rows
    )
    got = sorted((r.page_id or 0, r.text) for r in H.extract_text(df).collect())
    assert got == want


def chosen(templates, url):
    if "://" not in (url or ""):
        return set(), set()
    host = re.sub(r"(?s)^.*?://([^/?#]*).*$", r"\1", url).lower()
    section = re.findall("^[^/]*://[^/]*/([^/]*)/", url)
    own = [templates.get(s, (set(), None)) for s in (host, f"{host}/{section[0] if section else ''}")]
    return own[0][0] | own[1][0], {c for _, c in own if c is not None}


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, f"http://h.org/{i}", ARTICLE) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in H.extract_text(df).collect()} == {PLAIN}


def test_nulls_repeats_and_empty_table(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, None, ARTICLE), (None, "http://h/x", None), (3, "no scheme", ""), (1, None, ARTICLE)]
    found = H.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.text) for r in found) == [(0, ""), (1, PLAIN), (1, PLAIN), (3, "")]
    assert H.extract_text(spark.createDataFrame([], schema)).collect() == []
