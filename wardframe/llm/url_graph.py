"""URL filters: path rules first, link propagation for the rest.

Hosts that a rule allows are trusted seeds, hosts that a rule blocks are
distrusted ones. Trust flows along the links between hosts as a personalised
PageRank; distrust flows against them, from a blocked host to those that link
to it. A host whose distrust outweighs its trust is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.common import quoted, stored

DAMPING = 0.85
MOST_ROUNDS = 1000
TOLERANCE = 1e-6
DISTRUST_SHARE = 0.5
# Fixed value: link targets in a start tag; quotes are optional.
LINK = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    on_host = (host == rule.host) | host.endswith("." + rule.host)
    return on_host & path.startswith(rule.path)


def rule_for(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The name and the verdict of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = _fits(rule, host, path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit("allow" if rule.allow else "block")).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (src, dst, weight): links from pages of one host to another host.

    Links are exploded and summed per pair of hosts in every task before the
    shuffle. Links without a host of their own stay within theirs and are no edges.
    """
    links = pages.select(
        host_of(quoted(url_col)).alias("src"),
        F.explode(F.regexp_extract_all(quoted(html_col), F.lit(LINK), F.lit(1))).alias("link"),
    )
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit(":"), F.col("link"))).otherwise(
        F.col("link")
    )
    targets = links.filter(F.col("link").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//")).select(
        "src", host_of(absolute).alias("dst")
    )
    return (
        targets.filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("weight"))
    )


def _flows(edges: DataFrame) -> DataFrame:
    """Rows (giver, taker, trust, distrust): the share of the giver's score that moves."""
    both = edges.select(
        F.col("src").alias("giver"),
        F.col("dst").alias("taker"),
        F.col("weight").alias("trust"),
        F.lit(0).cast("long").alias("distrust"),
    ).unionByName(
        edges.select(
            F.col("dst").alias("giver"),
            F.col("src").alias("taker"),
            F.lit(0).cast("long").alias("trust"),
            F.col("weight").alias("distrust"),
        )
    )
    totals = both.groupBy("giver").agg(
        F.greatest(F.sum("trust"), F.lit(1)).alias("out"),
        F.greatest(F.sum("distrust"), F.lit(1)).alias("back"),
    )
    return both.join(totals, "giver").select(
        "giver",
        "taker",
        (F.col("trust") / F.col("out")).alias("trust"),
        (F.col("distrust") / F.col("back")).alias("distrust"),
    )


def _change(now: Column, before: Column) -> tuple[Column, Column]:
    """The change as a share of the greater score, and whether the score is the first one."""
    share = F.abs(now - before) / F.greatest(now, before)
    return F.when(now == before, F.lit(0.0)).otherwise(share), (now > 0) & (before == 0)


def propagate(
    seeds: DataFrame,
    edges: DataFrame,
    damping: float = DAMPING,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """Rows (host, trust, distrust), settled to ``tolerance``, or after ``rounds`` if that is given.

    A score has settled when it changes by no more than ``tolerance`` of itself,
    however small it is, since verdicts compare a host's scores with each other.
    The run does not end while scores still reach new hosts, so chains of any
    length are followed to their ends, and for ``rounds`` more if they are longer
    than that. Changes shrink by ``damping`` a round from then on; if they have
    not settled ``most_rounds`` later, it is an error.

    ``seeds`` holds (host, trust, distrust), both columns together summing to 1,
    so that the two scores are on one scale. The restart goes to the seeds; a
    host without outgoing links gives nothing on.
    Each round is one join and one sum over the edges, written to the shared
    folder; only the largest change and whether a host is new reach the driver.
    """
    flows = stored(_flows(edges), "flows")
    ranks = seeds
    done, last_new = 0, 0
    while rounds is None or last_new == done or done < (rounds if last_new <= rounds else last_new + rounds):
        moved = flows.alias("f").join(
            ranks.withColumnsRenamed({"trust": "t", "distrust": "d"}),
            F.col("f.giver") == F.col("host"),
        ).select(
            F.col("f.taker").alias("host"),
            (F.col("f.trust") * F.col("t") * damping).alias("trust"),
            (F.col("f.distrust") * F.col("d") * damping).alias("distrust"),
            F.lit(0.0).alias("was_t"),
            F.lit(0.0).alias("was_d"),
        )
        zero = F.lit(0.0)
        restart = seeds.select(
            "host",
            (F.col("trust") * (1 - damping)).alias("trust"),
            (F.col("distrust") * (1 - damping)).alias("distrust"),
            zero.alias("was_t"),
            zero.alias("was_d"),
        )
        before = ranks.select(
            "host",
            zero.alias("trust"),
            zero.alias("distrust"),
            F.col("trust").alias("was_t"),
            F.col("distrust").alias("was_d"),
        )
        after = stored(
            moved.unionByName(restart)
            .unionByName(before)
            .groupBy("host")
            .agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "was_t", "was_d")]),
            "ranks",
        )
        ranks = after.select("host", "trust", "distrust")
        pairs = [("trust", "was_t"), ("distrust", "was_d")]
        changes, news = zip(*[_change(F.col(c), F.col(was)) for c, was in pairs])
        change, new = after.agg(F.max(F.greatest(*changes)), F.max(F.greatest(*news))).first()
        done += 1
        if new:
            last_new = done
        elif change is None or change <= tolerance:
            break
        elif done > last_new + most_rounds:
            raise RuntimeError(f"scores still change by {change} after {done} rounds")
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    distrust_share: float = DISTRUST_SHARE,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Rows (id, host, path, rule, verdict, trust, distrust), one per page row.

    The longest fitting rule decides. A page without one follows its host: it
    is blocked if distrust makes up more than ``distrust_share`` of what the
    host has, and allowed otherwise, also where nothing has reached the host.
    A null URL or one without ``://`` has an empty host and path and is allowed.
    Null html has no links. Repeated rows are judged alike and each link counts.
    An empty table gives an empty table; other columns are not looked at.
    """
    url = quoted(url_col)
    parts = pages.select(
        quoted(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    name, verdict = rule_for(rules, F.col("host"), F.col("path"))
    ruled = parts.withColumns({"rule": name, "by_rule": verdict})
    per_host = (
        ruled.filter("by_rule IS NOT NULL AND host <> ''")
        .groupBy("host")
        .agg(
            F.count_if(F.col("by_rule") == "allow").alias("trust"),
            F.count_if(F.col("by_rule") == "block").alias("distrust"),
        )
    )
    per_host = stored(per_host, "seed-hosts")
    total = max(per_host.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 0, 1)
    seeds = per_host.select(
        "host",
        (F.col("trust") / total).alias("trust"),
        (F.col("distrust") / total).alias("distrust"),
    )
    ranks = propagate(seeds, host_edges(pages, url_col, html_col))
    scored = ranks.withColumnRenamed("host", "ranked")
    # The pages come first: a host with a third of them may then be split.
    joined = ruled.join(scored, F.col("host") == F.col("ranked"), "left")
    trust = F.coalesce(F.col("trust"), F.lit(0.0))
    distrust = F.coalesce(F.col("distrust"), F.lit(0.0))
    by_host = F.when(distrust > distrust_share * (trust + distrust), "block").otherwise("allow")
    return joined.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", by_host).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
