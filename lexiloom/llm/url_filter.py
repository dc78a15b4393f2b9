"""URL filters: host-suffix and path-prefix expressions, joined by short hash prefixes.

A rule names a host and the beginning of a path; it fits its host, all subdomains and every path that begins so. Each URL is
expanded into the expressions that could be a rule: every suffix of its host at a dot with every beginning of its path whose
length occurs among the rules. The expressions are looked up by the first bits of their digest in an equi-join; a hit is
confirmed by the full digest. The longest confirmed rule decides; of equally long ones the one with the longer host, then
the smaller text. Rules that repeat are one rule; if they disagree, block wins. URLs without a rule get ``default``.

Null URLs and URLs without ``://`` have an empty host and path. Every row is returned, repeated rows one by one. Rules with
a null part are left out. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.operators.lookup import lookup_join

#: (host, beginning of the path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Hexadecimal digits of the digest that the join compares.
PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, without query and fragment."""
    at = F.locate("://", url)
    rest = F.substr(url, at + 3)
    known = at > 0
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def expression(host: Column, path: Column) -> Column:
    """One text for a host and the beginning of a path; their border stays visible."""
    return F.concat(host, F.lit("\n"), path)


def rule_table(rules: DataFrame) -> DataFrame:
    """Distinct rules (host, path, verdict) with their digests."""
    known = rules.dropna(subset=["host", "path", "verdict"])
    known = known.groupBy(F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"))
    known = known.agg(F.max(F.col("verdict") == "block").alias("blocks"))
    digest = F.sha2(expression(F.col("rule_host"), F.col("rule_path")), 256)
    return known.select(
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        F.length(F.concat("rule_host", "rule_path")).alias("rule_length"),
        F.length("rule_path").alias("path_length"),
        F.when(F.col("blocks"), "block").otherwise("allow").alias("rule_verdict"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url)."""
    table = rule_table(rules)
    # Distinct lengths of rule paths: no more than a URL has characters, whatever the number of rules.
    lengths = sorted(r[0] for r in table.select("path_length").distinct().collect())
    lengths = F.array(*map(F.lit, lengths)) if lengths else F.expr("cast(array() as array<int>)")
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path).drop("url")
    dots = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(dots)), lambda i: F.array_join(F.slice(dots, i, F.size(dots)), "."))
    begins = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr("path", F.lit(1), n)
    )
    wanted = F.flatten(F.transform(F.array_distinct(suffixes), lambda h: F.transform(begins, lambda p: expression(h, p))))
    # Pages with the same host and beginning share their expressions: looked up once per distinct host and path.
    distinct = split.select(expression(F.col("host"), F.col("path")).alias("_url"), "host", "path").distinct()
    asked = (
        distinct.select("_url", F.explode(wanted).alias("expression"))
        .withColumn("digest", F.sha2("expression", 256))
        .select("_url", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"))
    )
    # The few rules of a prefix are one row, so that expressions of a frequent prefix need not meet in one task.
    by_prefix = table.groupBy("prefix").agg(
        F.collect_list(F.struct("rule_digest", "rule_length", "host_length", "rule", "rule_verdict")).alias("rules")
    )
    hits = lookup_join(asked, by_prefix, "prefix", "inner")
    confirmed = hits.select("_url", F.explode(F.filter("rules", lambda x: x["rule_digest"] == F.col("digest"))).alias("hit"))
    confirmed = confirmed.select("_url", "hit.*")
    order = F.struct("rule_length", "host_length", F.expr("transform(split(rule, ''), c -> -ascii(c))").alias("text"))
    best = confirmed.groupBy("_url").agg(F.max_by(F.struct("rule", "rule_verdict"), order).alias("best"))
    # Pages without a host, and those of a popular URL, share a key.
    keyed = split.select("page_id", "host", "path", expression(F.col("host"), F.col("path")).alias("_url"))
    return lookup_join(keyed, best, "_url", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )


ORACLE = """
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM parts),
ranked AS (
  SELECT s.page_id, s.host, s.path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS n
  FROM split s LEFT JOIN rules ON (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM ranked WHERE n = 1
"""
