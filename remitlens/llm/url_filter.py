"""URL filters by link-graph propagation: rules where one fits, personalised PageRank over hosts where none does.

A rule names a host, with all its subdomains, and a begin of the path; the longest rule that fits decides. Urls without
a rule are judged by their host. Hosts are joined by edges: host a has an edge to host b if a page of a links to b
(``href`` with a host of its own; links inside a host are no edges). A host of whose urls at least half are allowed by a rule is
a trusted seed, one of which at least half are blocked a blocked seed.

- Trust is personalised PageRank from the trusted seeds along the edges: who trusted hosts link to is likely good.
- Distrust is personalised PageRank from the blocked seeds along the reversed edges: who links to blocked hosts is likely bad.

Each rank is summed round by round: a round passes ``DAMPING`` percent of the mass that arrived in the round before to the
neighbours, in equal parts. Mass is whole numbers, so that sums do not depend on the order of rows, and ends by itself
once parts fall below one. A host's ranks are compared as shares of their totals: it is blocked if its distrust exceeds both
``LEAST`` of all distrust and its trust by ``MARGIN``; otherwise its urls are allowed.

Everything is DataFrame expressions. Pages are scanned twice: for edges, which are distinct pairs of hosts with partial sums
before the shuffle, and for verdicts. Rounds hold hosts only. The verdicts that differ from the default go back to the pages
by host and salt, so that a host with a third of all pages is spread over ``SALTS`` tasks.

Defined cases: null urls, and those without ``://``, have an empty host and path, fit no rule and are allowed; null html has
no links; a host of its own (seeds and edges) is every non-empty host; ties cannot arise, as two rules of one length that fit
one url are the same rule; repeated rows are rows of their own and count again in a seed's share; long texts are searched
whole; columns of the input under the names that are added are replaced, all others stay; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import ascii_lower, shielded, without
from remitlens.storage import stored

ALLOW, BLOCK = "allow", "block"
ADDED = ("host", "path", "rule", "verdict")
#: Mass of all seeds together, and percent of a round's mass that is passed on.
MASS = 10**15
DAMPING = 85
#: Rounds after which less than a hundredth of the mass is on its way.
ROUNDS = 30
#: Share of a host's urls that makes it a seed, in percent.
SEED_SHARE = 50
#: Least share of all distrust that blocks a host, and how many times its share of trust it must exceed.
LEAST, MARGIN = 1e-6, 1.0
SALTS = 16
#: A url's host and path, and the host of a link that names one.
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"


#: The rules of the registered query.
RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def _longest(rules: Sequence[Rule], value) -> Column:
    """``value`` of the longest rule that fits the columns host and path; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        out = F.when(_fits(rule), value(rule)).otherwise(out)
    return out


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``pages`` with host, path, the rule that decides (null if none) and _ruled, its verdict."""
    parsed = without(pages, *ADDED).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return parsed.withColumns({"rule": _longest(rules, lambda r: F.lit(r.host + r.path)), "_ruled": _longest(rules, lambda r: F.lit(r.verdict))})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct links between different hosts; ``pages`` has host and html."""
    found = F.transform(F.regexp_extract_all("html", F.lit(_LINK), 1), ascii_lower)
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    return links.where("src <> dst").distinct()


def seeds(pages: DataFrame) -> DataFrame:
    """(host, kind): hosts whose urls the rules mostly decide one way; ``pages`` has host and _ruled."""
    counts = [F.sum((F.col("_ruled") == kind).cast("long")).alias(kind) for kind in (ALLOW, BLOCK)]
    shares = pages.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), *counts)
    kind = F.when(100 * F.coalesce(BLOCK, F.lit(0)) >= SEED_SHARE * F.col("n"), BLOCK).when(100 * F.coalesce(ALLOW, F.lit(0)) >= SEED_SHARE * F.col("n"), ALLOW)
    return shares.select("host", kind.alias("kind")).where("kind IS NOT NULL")


def ranks(edges: DataFrame, own: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, kind, rank): trust of hosts under ``allow`` and distrust under ``block``, from the seeds ``own``.

    ``edges`` is (src, dst). Both ranks move in the same rounds, distrust against the edges.
    """
    forth = edges.select(F.lit(ALLOW).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("next"))
    back = edges.select(F.lit(BLOCK).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("next"))
    both = forth.unionByName(back)
    steps = stored(both.join(both.groupBy("kind", "host").agg(F.count("*").alias("degree")), ["kind", "host"]), "host-edges")
    number = own.groupBy("kind").agg(F.count("*").alias("seeds"))
    now = stored(own.join(F.broadcast(number), "kind").select("host", "kind", F.expr(f"{MASS} div seeds").alias("rank")), "seed-ranks")
    waves = now
    for _ in range(rounds if steps.limit(1).count() else 0):
        part = F.expr(f"(rank * {DAMPING}) div (100 * degree)")
        passed = now.join(steps, ["host", "kind"]).select(F.col("next").alias("host"), "kind", part.alias("rank")).where("rank > 0")
        now = stored(passed.groupBy("host", "kind").agg(F.sum("rank").alias("rank")), "rank-wave")
        if not now.limit(1).count():
            break
        waves = waves.unionByName(now)
    return waves.groupBy("host", "kind").agg(F.sum("rank").alias("rank"))


def blocked_hosts(ranked: DataFrame, least: float = LEAST, margin: float = MARGIN) -> DataFrame:
    """(host): hosts that are distrusted enough. Masses are whole numbers below 2**53, so their shares are exact to the bit."""

    def share(kind: str) -> Column:
        of_kind = F.sum(F.when(F.col("kind") == kind, F.col("rank")))
        total = ranked.agg(F.greatest(F.coalesce(of_kind, F.lit(0)), F.lit(1)).cast("double").alias("total")).scalar()
        return (F.coalesce(of_kind, F.lit(0)).cast("double") / total).alias(kind)

    shares = ranked.groupBy("host").agg(share(ALLOW), share(BLOCK))
    return shares.where((F.col(BLOCK) >= least) & (F.col(BLOCK) > margin * F.col(ALLOW))).select("host")


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """``pages`` (with url and html) with host, path, rule and verdict."""
    own, restored = shielded(without(pages, *ADDED), "_ruled", "_salt", "_bad")
    rows = ruled(own, rules)
    ranked = stored(ranks(stored(host_edges(rows.select("host", "html")), "links"), stored(seeds(rows.select("host", "_ruled")), "seeds"), rounds), "ranks")
    bad = blocked_hosts(ranked).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("_bad", F.lit(True))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in own.columns if c != "html"]), F.lit(SALTS)).cast("int")
    met = rows.withColumn("_salt", spread).join(bad, ["host", "_salt"], "left")
    verdict = F.coalesce("_ruled", F.when(F.col("_bad"), BLOCK).otherwise(ALLOW))
    return restored(met.withColumn("verdict", verdict), *ADDED)
