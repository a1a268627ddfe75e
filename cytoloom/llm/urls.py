"""URL filters: longest-match rules, then trust and distrust carried over the links between hosts.

Pages give host edges (absolute and protocol-relative href and src; links within a host
don't count). Rules give seeds: the share of a host's pages that a block rule decides seeds
distrust, the share an allow rule decides seeds trust. Personalised PageRank moves trust
along the edges, from a host to those it links to. Distrust goes against them, from a host
to those that link to it: each takes the mean over its own links, so it tells how bad a
host's links are, however many others link to the same hosts. A host is blocked if distrust exceeds trust by at least `margin`
of what a wholly blocked host has of itself. Scores are whole numbers of 10^-9, so sums
don't depend on their order.

The walks leak: a seed gives its host up to 1 - damping, not a share of one distribution, and
what reaches a host without links ends there instead of starting again at the seeds. So
scores compare hosts with a wholly allowed or blocked one; they don't add up to 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, small, staged, table

ONE = 10**9
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?:[hH][rR][eE][fF]|[sS][rR][cC])[ \t\n\f\r]*=[ \t\n\f\r]*["']?[ \t\n\f\r]*(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"' \t\n\f\r>]+)"""
#: Rounds of the walks.
STEPS = 30
DAMPING, MARGIN = 0.85, 0.5
#: Rules are one expression; a longer list belongs in a table.
MOST_RULES = 2000


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """(verdict, rule) of the longest rule that fits host and path, or null. Of rules equally long the first in code point order wins."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = F.lit(None)
    for verdict, rule in sorted(sorted(rules, key=lambda r: r[1], reverse=True), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, w): links from pages of one host to another."""
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> dst and src <> ''")
    return links.groupBy("src", "dst").agg(F.count("*").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS, own_links: bool = False) -> DataFrame:
    """(host, trust, distrust) in units of 10^-9 from seeds (host, trust, distrust in 0..1) and edges (src, dst, w).

    Stops after `steps`, or when no score moves. Both walks share
    one table: edges forward carry trust, edges backward distrust. Hosts that are only
    linked to take part; an empty table of edges leaves the seeds. own_links: a host's
    distrust is the mean over its own links, whatever else links to their targets.
    """
    both = edges.selectExpr("src as a", "dst as b", "w", "'trust' as k").unionByName(edges.selectExpr("dst as a", "src as b", "w", "'distrust' as k"))
    both = both.withColumn("by", F.when((F.col("k") == "distrust") & F.lit(own_links), F.col("b")).otherwise(F.col("a")))
    total = both.groupBy("by", "k").agg(F.sum("w").alias("t"))
    both = staged(both.join(total, ["by", "k"]).drop("by"), "host-edges")
    base = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (k, seed)")).where("seed > 0")
    base = staged(base.select("host", "k", F.round(F.col("seed") * ((1 - damping) * ONE)).cast("long").alias("own")), "host-seeds")
    ranks = base.select("host", "k", F.col("own").alias("x"))
    if both.limit(1).count():
        ranks = staged(ranks, "host-ranks")
        for _ in range(steps):
            share = F.floor(F.col("x") * (damping * F.col("w") / F.col("t")))
            sent = both.join(ranks.withColumnRenamed("host", "a"), ["a", "k"]).select(F.col("b").alias("host"), "k", share.alias("x"))
            new = sent.unionByName(base.select("host", "k", F.col("own").alias("x"))).groupBy("host", "k").agg(F.sum("x").alias("x"))
            new = staged(new, "host-ranks")
            moved = new.join(ranks.withColumnRenamed("x", "y"), ["host", "k"], "full").agg(F.max(F.abs(F.coalesce("x", F.lit(0)) - F.coalesce("y", F.lit(0))))).first()[0]
            discard(ranks)
            ranks = new
            if not moved:
                break
    return ranks.groupBy("host").agg(*[F.sum(F.when(F.col("k") == k, F.col("x")).otherwise(0)).alias(k) for k in ("trust", "distrust")])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, damping: float = DAMPING, margin: float = MARGIN) -> DataFrame:
    """id, host, path, rule, verdict, trust and distrust (units of 10^-9) of every row.

    Null urls and urls without :// have an empty host and path, which no rule fits and no
    link reaches: allowed. Null html has no links. Repeated rows count as pages of their
    host and give repeated results. Urls and html of any length are read whole. Of rules
    equally long the first by code point holds. An empty table gives an empty result; other
    columns are not read.
    """
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), tuple(rules)))
    share = lambda v: F.sum(F.when(F.col("r.verdict") == v, 1).otherwise(0)) / F.count("*")
    seeds = rows.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")).where("host <> ''")
    scores = propagate(seeds, host_edges(pages, url_col, html_col), damping, own_links=True)
    scores = small(staged(scores, "host-scores"))
    bad = F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0)) >= round(margin * (1 - damping) * ONE)
    return rows.join(scores, "host", "left").select(
        id_col,
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0)).cast("long").alias("trust"),
        F.coalesce("distrust", F.lit(0)).cast("long").alias("distrust"),
    )


def op8_urls(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    q = lambda t: "'" + t.replace("'", "''") + "'"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    fits = []
    for _, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits.append(f"when (host = {q(name)} or ends_with(host, {q('.' + name)})) and starts_with(path, {q(slash + rest)}) then {q(rule)}")
    verdict = " ".join(f"when {q(rule)} then {q(v)}" for v, rule in RULES)
    rounds = "".join(
        f" r{i + 1} as materialized (select host, k, sum(x)::bigint as x from (select b as host, e.k, floor(x * ({DAMPING}e0 * w / t))::bigint as x from e join r{i} on r{i}.host = e.a and r{i}.k = e.k union all select host, k, own from base) group by host, k),\n"
        for i in range(STEPS)
    )
    return f"""
with p0 as (select page_id, coalesce(html, '') as html, {lower(f"regexp_extract(coalesce(url, ''), {q(URL)}, 1)")} as host, regexp_extract(coalesce(url, ''), {q(URL)}, 2) as path from pages),
 p1 as (select *, case {" ".join(fits)} end as rule from p0),
 p as (select *, case rule {verdict} end as ruled from p1),
 l as (select host as src, {lower("x")} as dst from (select host, unnest(regexp_extract_all(html, {q(LINK)}, 1)) as x from p)),
 l1 as (select src, dst, count(*) as w from l where src <> dst and src <> '' group by src, dst),
 l2 as (select src as a, dst as b, src as by_, w, 'trust' as k from l1 union all select dst, src, src, w, 'distrust' from l1),
 t as (select by_, k, sum(w) as t from l2 group by by_, k),
 e as materialized (select a, b, w, l2.k, t from l2 join t on l2.by_ = t.by_ and l2.k = t.k),
 h as (select host, count(*) filter (where ruled = 'allow') / count(*)::double as trust, count(*) filter (where ruled = 'block') / count(*)::double as distrust from p where host <> '' group by host),
 seeds as (select host, 'trust' as k, trust as seed from h union all select host, 'distrust', distrust from h),
 base as materialized (select host, k, round(seed * {(1 - DAMPING) * ONE!r}::double)::bigint as own from seeds where seed > 0),
 r0 as (select host, k, own as x from base),
{rounds} s as (select host, sum(x) filter (where k = 'trust') as trust, sum(x) filter (where k = 'distrust') as distrust from r{STEPS} group by host)
select page_id, p.host, path, rule, coalesce(ruled, case when coalesce(distrust, 0) - coalesce(trust, 0) >= {round(MARGIN * (1 - DAMPING) * ONE)} then 'block' else 'allow' end) as verdict,
       coalesce(trust, 0)::bigint as trust, coalesce(distrust, 0)::bigint as distrust
from p left join s on s.host = p.host
"""


OP8_SQL = _oracle()
