"""URL filters: host and path rules, and for the rest trust and distrust propagated over host links.

The rules judge what they fit, the longest first. Hosts take trust from their pages that a rule allows and distrust from
those that one blocks. Trust flows along links (personalised PageRank from the trusted seeds), distrust against them (a
host that links to blocked hosts), both on the host graph, whose edges are counted links: a link without a host of its
own points to the page's host. A host whose share of distrust reaches ``THRESHOLD`` is blocked; one that neither reaches
is allowed. Every round is a join and a sum in Spark, ended by a table in the shared folder, until a round moves no more
than ``TOLERANCE`` of all mass, or has to by its number. What a walk leaves a host counts from ``LEAST`` of all mass on; the tolerance is so much
smaller that no verdict hangs on the number of rounds. The pages of hosts with a large share of all pages are not shuffled
for their verdict.

Defined cases: a url that is null or has no ``://`` has an empty host and path, which no rule fits, and is allowed. Null
html has no links. Repeated rows count as pages of their own. Further columns are not read.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderline.llm.hot import joined
from ladderline.session import stage, unstage

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
DAMPING, THRESHOLD = 0.85, 0.5
TOLERANCE, LEAST = 1e-14, 1e-12
"""What a round may still move, and what a host has to get, as shares of all mass."""


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst, links)``: how many links lead from one host to another."""
    targets = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    away = F.transform(targets, lambda u: F.when(u.startswith("//"), host_of(F.concat(F.lit("x:"), u))).otherwise(host_of(u)))
    pages = pages.select(host_of(F.col(url_col)).alias("src"), away.alias("away"))
    # links of one page to one host are counted within the row, so that a page gives a row per host it links to
    counted = pages.select("src", "away", F.explode(F.array_distinct("away")).alias("dst"))
    counted = counted.select("src", F.when(F.col("dst") == "", F.col("src")).otherwise(F.col("dst")).alias("dst"), F.expr("size(filter(away, h -> h = dst))").alias("n"))
    return counted.where("src != '' and dst != ''").groupBy("src", "dst").agg(F.sum("n").alias("links"))


def propagated(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(host, mass)`` of a walk from ``(host, seed)`` along ``(src, dst, share)``: each round, ``DAMPING`` of the mass
    moves on and the rest starts again at the seeds; mass of hosts without an edge starts again as well. Hosts with less
    than ``LEAST`` of all mass count as not reached."""
    seeds = seeds.where("seed > 0")
    total = seeds.agg(F.sum("seed")).first()[0] or 0
    mass = seeds.select("host", F.col("seed").cast("double").alias("mass"))
    # a round moves at most DAMPING of what the one before it moved, so that after these the rest is below the tolerance
    for _ in range(math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING)) if total else 0):
        moved = mass.join(edges, mass.host == edges.src).groupBy(F.col("dst").alias("host")).agg((DAMPING * F.sum(F.col("mass") * F.col("share"))).alias("moved"))
        moved = stage(moved, "moved")
        kept = moved.agg(F.sum("moved")).first()[0] or 0.0
        back = seeds.select(F.col("host").alias("h"), (F.col("seed") * F.lit((total - kept) / total)).alias("back"))
        after = moved.join(back, F.col("host") == F.col("h"), "full").select(F.coalesce("host", "h").alias("host"), (F.coalesce("moved", F.lit(0.0)) + F.coalesce("back", F.lit(0.0))).alias("mass"))
        after = stage(after, "mass")
        old = mass.select(F.col("host").alias("h"), F.col("mass").alias("old"))
        change = after.join(old, F.col("host") == F.col("h"), "full").agg(F.sum(F.abs(F.coalesce("mass", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0
        unstage(moved)
        unstage(mass)
        mass = after
        if change <= TOLERANCE * total:
            break
    return mass.where(F.col("mass") >= F.lit(LEAST * total))


def _shares(links: DataFrame) -> DataFrame:
    out = links.groupBy("src").agg(F.sum("links").alias("of"))
    return stage(links.join(out, "src").select("src", "dst", (F.col("links") / F.col("of")).alias("share")), "shares")


def host_scores(pages: DataFrame, judged: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``(host, trust, distrust, blocked)`` of every host that trust or distrust reaches."""
    action = dict(rules)
    allowed, blocked = ([t for t, a in action.items() if a == kind] for kind in ("allow", "block"))
    counts = judged.where("host != ''").groupBy("host").agg(
        F.count_if(F.col("rule").isin(allowed)).alias("good"), F.count_if(F.col("rule").isin(blocked)).alias("bad")
    )
    counts = stage(counts, "seeds")
    links = stage(host_links(pages), "host-links")
    trust = propagated(_shares(links), counts.select("host", F.col("good").alias("seed")))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = propagated(_shares(against), counts.select("host", F.col("bad").alias("seed")))
    both = trust.select("host", F.col("mass").alias("trust")).join(distrust.select("host", F.col("mass").alias("distrust")), "host", "full").na.fill(0.0)
    return both.withColumn("blocked", (F.col("distrust") > 0) & (F.col("distrust") >= THRESHOLD * (F.col("trust") + F.col("distrust"))))


def judged_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every page."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = named.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parsed.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    scores = stage(host_scores(named, judged, rules).where("blocked").select("host", "blocked"), "blocked")
    pages_of = judged.groupBy("host").agg(F.count("*").alias("pages")).join(scores, "host", "left")
    action = F.create_map(*[F.lit(x) for r in rules for x in r])
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    out = joined(judged, stage(pages_of, "page-hosts"), "host", "pages")
    return out.select("id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), action[F.col("rule")]).otherwise(by_host).alias("verdict"))
