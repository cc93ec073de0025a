"""URL filters with trust and distrust carried over links between hosts (operator 10).

A page whose URL fits a rule gets the verdict of the longest rule that fits.  For
the others hosts are judged: a host is a trusted seed with the share of its pages
that rules allow as weight, and a blocked seed with the share that rules block.  Trust
flows along links between hosts as personalised PageRank from the trusted seeds;
distrust flows against the links from the blocked seeds (who links to a blocked
host is suspect).  A host is blocked if its distrust, to four digits, is more than
``threshold`` of its trust and distrust together; a host that neither reaches is allowed.

Links are the ``href`` of ``a`` tags outside comments: ``scheme://host`` and ``//host`` name
their host, links without a scheme the host of the page's ``<base href>`` (without
one they stay on their own host and are no link between hosts).

DataFrame operations only.  Links are cut to distinct host pairs before any
join, so a page or host with very many links costs rows only in the scan.

Defined results: a null URL or one without ``://`` has empty host and path, fits
no rule and is allowed; null html has no links; repeated rows are repeated in the
result; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.staging import prepare, read, stage

#: (verdict, host, path) of the rules, fixed values.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HREF_OF = r"""[\x09-\x0D\x20](?:[^>]*?["'\x09-\x0D\x20])?href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?([^"'\x09-\x0D\x20>]+)"""
LINK, BASE = "(?i)<a" + _HREF_OF, "(?i)<base" + _HREF_OF
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, THRESHOLD = 0.85, 0.5
#: Scores have settled when no host's score grows by more than this share of itself.
SETTLED = 1e-6
#: Of the SQL only: steps after which 0.85 ** ROUNDS is far below SETTLED.
ROUNDS = 200


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does.

    The rules are a parameter and become one CASE over two string tests each.
    """
    found = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def absolute(url: Column) -> Column:
    """``//host...`` with a scheme; other links as they are."""
    return F.when(url.startswith("//"), F.concat(F.lit("http:"), url)).otherwise(url)


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links (src, dst) between different hosts."""
    open_html = F.when(F.col("html").contains("<!--"), F.regexp_replace("html", COMMENT, "")).otherwise(F.col("html"))
    # what is known of a page is worked out before its links are unfolded, once for each page
    whole = pages.select(host_of(F.col("url")).alias("src"), host_of(absolute(F.regexp_extract(open_html, BASE, 1))).alias("base"),
                         F.array_distinct(F.regexp_extract_all(open_html, F.lit(LINK), 1)).alias("links"))
    found = whole.select("src", "base", F.explode("links").alias("to"))
    to = absolute(F.col("to"))
    dst = F.when(to.rlike(SCHEME + "//"), host_of(to)).when(~to.rlike(SCHEME), F.col("base")).otherwise("")
    return (found.select("src", dst.alias("dst"))
            .filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .distinct())


def spread(links: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank ``(host, score)`` over links (src, dst) from ``seeds(host, weight)``.

    Every seed starts with its weight (1 without the column); what flows into a host without outgoing links
    ends there.  Scores only grow, so they are iterated until a round reaches no new
    host and lets no score grow by more than SETTLED of itself, however far the
    hosts are from the seeds; ``rounds`` stops earlier.
    """
    out = links.groupBy("src").agg(F.count("*").alias("n"))
    shares = stage(links.join(out, "src").select("src", "dst", (F.lit(damping) / F.col("n")).alias("share")),
                   "url-shares")
    weight = F.col("weight") if "weight" in seeds.columns else F.lit(1.0)
    base = stage(seeds.select("host", (F.lit(1.0 - damping) * weight).alias("base")), "url-seeds")
    scores = base.select("host", F.col("base").alias("score"))
    for _ in count() if rounds is None else range(rounds):
        flow = (scores.join(shares, scores["host"] == shares["src"])
                .select(F.col("dst").alias("host"), (F.col("score") * F.col("share")).alias("score")))
        new = stage(flow.union(base.select("host", F.col("base"))).groupBy("host")
                    .agg(F.sum("score").alias("score")), "url-scores")
        moved = new.join(scores.select("host", F.col("score").alias("old")), "host", "left").filter(
            F.col("score") - F.coalesce("old", F.lit(0.0)) > SETTLED * F.col("score"))
        scores, still = new, moved.isEmpty()
        if still:
            break
    return scores


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    hosts = stage(parts.filter("host != ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("fit.verdict") == "allow").alias("good"),
        F.count_if(F.col("fit.verdict") == "block").alias("bad")), "url-hosts")
    links = stage(host_links(pages), "url-links")
    trust = spread(links, hosts.filter("good > 0").select("host", (F.col("good") / F.col("n")).alias("weight")))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    doubt = spread(back, hosts.filter("bad > 0").select("host", (F.col("bad") / F.col("n")).alias("weight")))
    blocked = (doubt.withColumnRenamed("score", "doubt").join(trust.withColumnRenamed("score", "trust"), "host", "left")
               .filter(F.round(F.col("doubt") / (F.col("doubt") + F.coalesce("trust", F.lit(0.0))), 4) > threshold)
               .select("host", F.lit("block").alias("host_verdict")))
    return (parts.join(blocked, "host", "left")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", "host_verdict", F.lit("allow")).alias("verdict")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    prepare(spark)
    return judge(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def _sql_spread(name: str, share: str, a: str, b: str) -> str:
    """PageRank as the sum of what arrives after 0, 1, 2 ... steps."""
    return f"""{name}_walk AS (
  SELECT host, {1.0 - DAMPING!r} * {share} / n AS flow, 0 AS k FROM hosts WHERE {share} > 0
  UNION ALL
  SELECT l.{b}, sum(w.flow * {DAMPING!r} / l.n_{a}), max(w.k) + 1 FROM {name}_walk w JOIN shares l ON l.{a} = w.host
  WHERE w.k < {ROUNDS} GROUP BY l.{b}),
{name} AS (SELECT host, sum(flow) AS score FROM {name}_walk GROUP BY host)"""


_HREF, _BASE = (x.replace("'", "''") for x in (LINK, BASE))
_ABSOLUTE = "CASE WHEN starts_with({0}, '//') THEN 'http:' || {0} ELSE {0} END"
_AZ = f"'{UPPER}', '{LOWER}'"

ORACLE_OP10 = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, regexp_replace(html, '{COMMENT}', '', 'g') AS html, coalesce(translate(regexp_extract(url, '{URL}', 1), {_AZ}), '') AS host,
         coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
urls AS (SELECT DISTINCT host, path FROM parts),
fits AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM urls JOIN rules ON ends_with('.' || host, '.' || h) AND starts_with(path, p) GROUP BY host, path),
ruled AS (SELECT parts.*, rule, verdict FROM parts LEFT JOIN fits USING (host, path)),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS good,
                 count(*) FILTER (verdict = 'block') AS bad FROM ruled WHERE host <> '' GROUP BY host),
bases AS (SELECT host, html, regexp_extract(html, '{_BASE}', 1) AS base FROM parts),
hrefs AS (SELECT host AS src, {_ABSOLUTE.format("base")} AS base, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS href FROM bases),
goals AS (SELECT src, base, {_ABSOLUTE.format("href")} AS href FROM hrefs),
links AS (SELECT DISTINCT src, dst FROM (
  SELECT src, translate(regexp_extract(CASE WHEN regexp_matches(href, '{SCHEME}//') THEN href
                                            WHEN NOT regexp_matches(href, '{SCHEME}') THEN base END, '{URL}', 1), {_AZ}) AS dst FROM goals)
  WHERE src <> '' AND dst <> '' AND src <> dst),
shares AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS n_src, count(*) OVER (PARTITION BY dst) AS n_dst FROM links),
{_sql_spread('trust', 'good', 'src', 'dst')},
{_sql_spread('doubt', 'bad', 'dst', 'src')}
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN round(d.score / (d.score + coalesce(t.score, 0)), 4) > {THRESHOLD} THEN 'block' END, 'allow') AS verdict
FROM ruled LEFT JOIN doubt d USING (host) LEFT JOIN trust t USING (host)
"""
