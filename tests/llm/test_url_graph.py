import pytest

from wardframe.llm.queries import RULES
from wardframe.llm.url_graph import Rule, host_edges, judge_urls, propagate

SCHEMA = "page_id long, url string, html string, host string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a clashing column") for i, (u, h) in enumerate(rows)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.ORG/es/1?x#y": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "https://org/": ("org", "/", "org/", "allow"),
        "https://x.org": ("x.org", "", None, "allow"),
        "https://x.org?q=/fr/": ("x.org", "", None, "allow"),
        "ftp://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"),
        "ftp://b.com/de/x://y/": ("b.com", "/de/x://y/", "com/de/", "block"),
        "no scheme/de/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    found = judge_urls(pages(spark, [(u, None) for u in cases]), RULES).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    # The hosts without a rule for the page follow what other pages of theirs have shown.
    assert got == dict(enumerate(cases.values()))


def link(*targets):
    return "".join(f'<p><A class=x HREF="{t}">t</a>' for t in targets)


LINKED = [
    ("https://good.org/", link("https://Friend.net/x", "//kind.net", "/own", "mailto:a@b", "https://good.org/2")),
    ("https://friend.net/a", link("https://kind.net/")),
    ("https://farm.net/", link("https://bad.com/de/", "http://bad.com/de/2")),
    ("https://hub.net/", link("https://farm.net/", "https://good.org/")),
    ("https://bad.com/de/", None),
    ("https://bad.com/de/", ""),
    ("https://alone.net/", "<p>no links"),
]


def test_edges_between_hosts(spark):
    found = {(r.src, r.dst): r.weight for r in host_edges(pages(spark, LINKED)).collect()}
    assert found == {
        ("good.org", "friend.net"): 1,
        ("good.org", "kind.net"): 1,
        ("friend.net", "kind.net"): 1,
        ("farm.net", "bad.com"): 2,
        ("hub.net", "farm.net"): 1,
        ("hub.net", "good.org"): 1,
    }


def brute_force(seeds, edges, damping, rounds):
    hosts = sorted({h for h, _, _ in seeds} | {h for e in edges for h in e[:2]})
    trust = {h: 0.0 for h in hosts} | {h: t for h, t, _ in seeds}
    distrust = {h: 0.0 for h in hosts} | {h: d for h, _, d in seeds}
    t, d = dict(trust), dict(distrust)
    for _ in range(rounds):
        t2 = {h: (1 - damping) * trust[h] for h in hosts}
        d2 = {h: (1 - damping) * distrust[h] for h in hosts}
        for a, b, w in edges:
            t2[b] += damping * t[a] * w / sum(x[2] for x in edges if x[0] == a)
            d2[a] += damping * d[b] * w / sum(x[2] for x in edges if x[1] == b)
        t, d = t2, d2
    return {h: (t[h], d[h]) for h in hosts}


def test_scores_equal_brute_force(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "a", 1), ("c", "d", 1)]
    seeds = [("a", 0.5, 0.0), ("d", 0.0, 0.5)]
    found = propagate(
        spark.createDataFrame(seeds, "host string, trust double, distrust double"),
        spark.createDataFrame(edges, "src string, dst string, weight long"),
        rounds=12,
        tolerance=0.0,
    )
    want = brute_force(seeds, edges, 0.85, 12)
    got = {r.host: (r.trust, r.distrust) for r in found.collect()}
    assert got.keys() == want.keys()
    for h in got:
        assert got[h] == pytest.approx(want[h], abs=1e-12)


def ranked(spark, seeds, edges, **kw):
    found = propagate(
        spark.createDataFrame(seeds, "host string, trust double, distrust double"),
        spark.createDataFrame(edges, "src string, dst string, weight long"),
        **kw,
    )
    return {r.host: (r.trust, r.distrust) for r in found.collect()}


def test_copies_of_a_web_get_the_scores_of_one(spark):
    edges = [("a", "b", 1), ("b", "c", 1), ("c", "d", 2), ("d", "e", 1), ("c", "e", 1), ("e", "z", 1)]
    seeds = [("a", 0.5, 0.0), ("z", 0.0, 0.5)]
    one = ranked(spark, seeds, edges, rounds=7)
    assert min(t for t, _ in one.values()) > 0 and min(d for _, d in one.values()) > 0
    # As of ten million copies, three of which are there.
    of = lambda h, i: f"{h}{i}"
    copies = ranked(
        spark,
        [(of(h, i), t * 1e-7, d * 1e-7) for h, t, d in seeds for i in range(3)],
        [(of(a, i), of(b, i), w) for a, b, w in edges for i in range(3)],
        rounds=7,
    )
    for i in range(3):
        for h, (t, d) in one.items():
            assert copies[of(h, i)] == pytest.approx((t * 1e-7, d * 1e-7), rel=1e-9)


@pytest.mark.parametrize("length", [3, 4, 9])
def test_chains_are_followed_to_their_ends(spark, length):
    edges = [(f"h{k}", f"h{k + 1}", 1) for k in range(length)]
    found = ranked(spark, [("h0", 1.0, 0.0)], edges, rounds=3)
    assert found.keys() == {f"h{k}" for k in range(length + 1)}
    assert all(t > 0 for t, _ in found.values())


def test_webs_with_cycles_settle(spark):
    # Hosts that link to each other and little else: after 20 rounds some scores are still under way.
    edges = [("a", "b", 9), ("b", "a", 9), ("b", "c", 1), ("c", "a", 1)]
    seeds = [("a", 0.5, 0.1), ("c", 0.1, 0.3)]
    found = ranked(spark, seeds, edges, tolerance=1e-4)
    settled = brute_force(seeds, edges, 0.85, 400)
    early = brute_force(seeds, edges, 0.85, 20)
    for host, scores in settled.items():
        assert found[host] == pytest.approx(scores, rel=1e-3)
    assert any(abs(early[h][0] / settled[h][0] - 1) > 2e-3 for h in settled)
    with pytest.raises(RuntimeError, match="still change"):
        ranked(spark, seeds, edges, most_rounds=2)


def test_verdicts_follow_the_links(spark):
    found = {r.host: r.verdict for r in judge_urls(pages(spark, LINKED), RULES).collect()}
    assert found == {
        "good.org": "allow",
        "friend.net": "allow",
        "farm.net": "block",
        "hub.net": "block",
        "bad.com": "block",
        "alone.net": "allow",
    }


def test_empty_table_repeats_and_no_rules(spark):
    assert judge_urls(pages(spark, []), RULES).collect() == []
    assert judge_urls(pages(spark, LINKED * 2), RULES).count() == 2 * len(LINKED)
    assert {r.verdict for r in judge_urls(pages(spark, LINKED), []).collect()} == {"allow"}
    only = [Rule("net", "/", False)]
    assert {r.verdict for r in judge_urls(pages(spark, LINKED), only).collect() if r.rule} == {"block"}


def test_the_sql_says_the_same(spark):
    import duckdb

    from wardframe.llm.oracles import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    extra = [("https://x.example.org/en/1", None), ("http://y.com/fr/", link("https://farm.net")), (None, None), ("odd", "")]
    rows = [(i, u, h) for i, (u, h) in enumerate(LINKED + extra)]
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    names = ["page_id", "host", "path", "rule", "verdict"]
    cursor = con.execute(ORACLES["op9_url_graph"])
    assert [c[0] for c in cursor.description] == names
    want = sorted(cursor.fetchall())
    found = judge_urls(pages(spark, LINKED + extra), RULES).select(*names)
    assert sorted(map(tuple, found.collect())) == want
