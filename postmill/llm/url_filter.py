"""URL filters: pattern rules behind an index by their rarest literal token, in DataFrame functions only.

A rule is a pattern over host and path, written `||host/path` (the host and its subdomains, the path
from its start), with `*` for anything, `^` for a separator or the end and a closing `|` for the end;
a pattern without `||` may begin anywhere. Its tokens are the runs of letters and digits that its own
characters bound on both sides, so that a URL that fits has them as whole tokens. Every rule is filed
under the token that the fewest URLs have (all URLs are counted). A URL's tokens fetch candidate rules
and only those run their regular expressions. Rules without a token are candidates for every URL.

The index is kept as one table of hashed slots in a scalar subquery while the rules number at most
`most_rules`: then no URL row moves. More rules are joined: distinct URLs are dealt by token, hot tokens
(by their count) over several keys, and each URL's best rule is found by a grouped maximum. Rules
without a token are tried on each distinct URL where it is.

Of the rules that fit, the one of the highest tier wins, then the longest, then the pattern that sorts
first (a blocking one before an allowing one). Without any the verdict is the default.

Null URLs, and those without ://, have an empty host and path, and no candidates. Each row is judged
for itself, repeated rows too; no rows give no rows, no rules the default for all. Repeated rules count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.decontaminate import folded

TOKEN = "[A-Za-z0-9]+"
RULES_SCHEMA = "pattern string, action string, tier int"
SLOTS = 4096
NO_RULES = "array<struct<token:string,rules:array<struct<tier:int,size:int,pattern:string,action:string,regex:string>>>>"


def host_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return folded(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def listed(spark: SparkSession, rules: list[tuple[str, str, int]]) -> DataFrame:
    """A short list of rules (pattern, action, tier) as a frame, without Python on the executors."""
    rows = F.array(*(F.struct(F.lit(p).alias("pattern"), F.lit(a).alias("action"), F.lit(t).alias("tier")) for p, a, t in rules))
    return spark.range(1).select(F.inline(rows))


def site_rules(spark: SparkSession, rules: list[tuple[str, str]], tier: int = 1) -> DataFrame:
    """Rules given as (action, host and path)."""
    return listed(spark, [("||" + site, action, tier) for action, site in rules])


def compiled(rules: DataFrame) -> DataFrame:
    """Distinct rules with their regular expression over host and path, and their tokens."""
    body = F.regexp_replace("pattern", r"^\|\||\|$", "")
    escaped = F.regexp_replace(body, r"([\\.\[\]{}()+?$\-|])", r"\\$1")
    wild = F.regexp_replace(F.regexp_replace(escaped, r"\*", ".*"), r"\^", "(?:[^A-Za-z0-9_.%\\\\-]|\\$)")
    regex = F.concat(F.when(F.col("pattern").startswith("||"), r"(?s)^(?:[^/]*\.)?").otherwise("(?s)"), wild, F.when(F.col("pattern").endswith("|"), r"\z").otherwise(""))
    tokens = F.array_distinct(F.regexp_extract_all("pattern", F.lit(f"(?<=[^A-Za-z0-9*])({TOKEN})(?=[^A-Za-z0-9*])"), F.lit(1)))
    clean = rules.where(F.col("pattern").isNotNull() & F.col("action").isNotNull() & (F.length(body) > 0))
    return clean.select("pattern", "action", F.coalesce("tier", F.lit(0)).alias("tier")).distinct().select("*", body.alias("text"), regex.alias("regex"), tokens.alias("tokens"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", most_rules: int = 2000, hot_urls: int = 1_000_000) -> DataFrame:
    """page_id, host, path, pattern (of the rule that decided, else null), tier, and verdict of each row."""
    spark = pages.sparkSession
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = compiled(rules)
    target = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(target, F.lit(f"({TOKEN})"), F.lit(1)))

    used = known.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.select(F.explode(tokens).alias("token")).join(used, "token").groupBy("token").agg(F.count("*").alias("seen"))
    filed = (
        known.withColumn("token", F.explode_outer("tokens"))
        .join(counts, "token", "left")
        .groupBy("pattern", "action", "tier", "text", "regex")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), F.coalesce("token", F.lit("")).alias("token"))).alias("rarest"))
        .select("rarest.*", F.struct("tier", F.length("text").alias("size"), "pattern", "action", "regex").alias("rule"))
    )
    #: Rules without a token are candidates for every URL, so each URL looks through all of them.
    loose = filed.where("token = ''").agg(F.collect_list("rule").alias("rules"))
    fits = lambda rules: F.filter(rules, lambda r: F.regexp_like(F.col("target"), r["regex"]))
    if rules.limit(most_rules + 1).count() <= most_rules:
        # The rules of a token are in the slot of its hash: each token of a URL looks at one slot, whatever the number of rules.
        slot = lambda token: F.pmod(F.xxhash64(token), F.lit(SLOTS)).cast("int")
        held = filed.where("token != ''").groupBy("token").agg(F.collect_list("rule").alias("rules")).groupBy(slot(F.col("token")).alias("slot")).agg(F.collect_list(F.struct("token", "rules")).alias("held"))
        index = spark.range(SLOTS).join(held, F.col("id") == F.col("slot"), "left").agg(F.array_sort(F.collect_list(F.struct("id", "held"))).alias("index")).select(F.transform("index", lambda x: x["held"]).alias("index"))
        fetched = F.flatten(F.transform("tokens", lambda t: F.flatten(F.transform(F.filter(F.coalesce(F.get("index", slot(t)), F.array().cast(NO_RULES)), lambda x: x["token"] == t), lambda x: x["rules"]))))
        first = F.array_sort(fits(F.concat(fetched, F.col("loose"))), lambda a, b: _order(a, b))
        judged = urls.withColumns({"target": target, "tokens": tokens, "index": index.scalar(), "loose": loose.scalar()}).withColumn("rule", F.when(F.col("target") != "", F.get(first, F.lit(0))))
    else:
        salts = F.greatest(F.lit(1), F.ceil(F.col("seen") / hot_urls)).cast("int")
        spread = filed.where("token != ''").select("token", salts.alias("salts"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "rule")
        wide = spread.groupBy("token").agg(F.max("salts").alias("salts"))
        distinct = urls.select(target.alias("target")).where("target != ''").distinct()
        dealt = distinct.select("target", F.explode(F.array_distinct(F.regexp_extract_all("target", F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
        dealt = dealt.join(wide, "token").withColumn("salt", F.pmod(F.xxhash64("target"), F.col("salts")).cast("int"))
        met = dealt.join(spread.drop("salts"), ["token", "salt"]).where(F.regexp_like("target", F.col("rule.regex"))).select("target", "rule")
        # Those without a token are tried where the URL is.
        met = met.unionByName(distinct.withColumn("loose", loose.scalar()).select("target", F.explode(fits(F.col("loose"))).alias("rule")))
        best = met.groupBy("target").agg(F.min(F.struct((-F.col("rule.tier")).alias("t"), (-F.col("rule.size")).alias("s"), (F.col("rule.action") != "block").alias("a"), F.col("rule.pattern").alias("p"), F.col("rule").alias("rule"))).alias("best"))
        judged = urls.withColumn("target", target).join(best.select("target", "best.rule"), "target", "left")
    return judged.select("page_id", "host", "path", F.col("rule.pattern").alias("pattern"), F.col("rule.tier").alias("tier"), F.coalesce("rule.action", F.lit(default)).alias("verdict"))


def _order(a: Column, b: Column) -> Column:
    less = lambda x, y: F.when(x < y, F.lit(-1)).when(x > y, F.lit(1))
    return F.coalesce(less(b["tier"], a["tier"]), less(b["size"], a["size"]), less(a["action"] != "block", b["action"] != "block"), less(a["pattern"], b["pattern"]), F.lit(0))


#: Fixed site rules: action, host and path.
SITES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Patterns of hosts and paths that serve advertising, betting or tracking.
PATTERNS = ["||ads.", "||ads-", ".ads-track.", "||ads-track.", "||free-bets.", ".free-bets.", "||casino.", ".casino.", "/ads/", "/tracker/", "/doubleclick/"]


def site_report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule (of SITES, else null) and verdict of each row, SITES going before PATTERNS."""
    spark = pages.sparkSession
    more = listed(spark, [(p, "block", 0) for p in PATTERNS])
    found = filter_urls(pages, site_rules(spark, SITES).unionByName(more))
    rule = F.when(F.col("tier") == 1, F.regexp_replace("pattern", r"^\|\|", ""))
    return found.select("page_id", "host", "path", rule.alias("rule"), "verdict")


ORACLE = r"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u),
j as (
  select page_id, host, path, case
    when (host = 'example.org' or suffix(host, '.example.org')) and prefix(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or suffix(host, '.example.org')) and prefix(path, '/es/') then 'example.org/es/'
    when (host = 'com' or suffix(host, '.com')) and prefix(path, '/fr/') then 'com/fr/'
    when (host = 'com' or suffix(host, '.com')) and prefix(path, '/de/') then 'com/de/'
    when (host = 'org' or suffix(host, '.org')) and prefix(path, '/') then 'org/' end as rule
  from p)
select page_id, host, path, rule, case
  when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block'
  when rule is not null then 'allow'
  when regexp_matches(host || path, '^(?:[^/]*\.)?(ads\.|ads-|ads-track\.|free-bets\.|casino\.)|\.ads-track\.|\.free-bets\.|\.casino\.|/ads/|/tracker/|/doubleclick/') then 'block'
  else 'allow' end as verdict
from j
"""
