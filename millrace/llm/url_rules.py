"""URL rules, indexed by their rarest literal token.

A rule is text without regular-expression signs. `example.org/es/` is a site rule: it fits
that host and all its subdomains where the path starts so; case counts in the path. A rule
with `^` or `*` is a pattern, looked for anywhere after `://`, upper or lower case A-Z
alike: `^` stands for one sign that is no letter or digit, or for the end, and `*` for any
signs. From each rule a regular expression is made, and the tokens (letters and digits)
that every fitting URL must have in full. The token that the fewest URLs hold leads a URL to
the rule; only then the expression runs. A rule without such a token meets all URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import packed
from millrace.operators.lineage import materialize
from millrace.operators.sizing import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Joins the rules without a mandatory token to every URL; no token is empty.
EVERY = ""
#: Addresses without `://` are dealt over so many keys, as none of them meets a rule.
DEALT = 1024


@dataclass(frozen=True)
class Rule:
    action: str
    text: str


#: Hosts and paths of the language editions that are wanted or not (fixed values of the task).
SITES = (
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"), Rule("block", "com/de/"),
)
#: Words of addresses whose pages are no reading: advertising, gambling, adult, spam, shops of pills, and service paths.
PATTERNS = tuple(
    Rule("block", f"^{w}^")
    for w in (
        "adult", "porn", "xxx", "sex", "casino", "gambling", "poker", "bets", "betting", "jackpot", "pills", "viagra",
        "pharmacy", "payday", "spam", "ads", "adserver", "doubleclick", "popads", "torrent", "warez",
        "login", "signin", "signup", "cart", "checkout", "wp-admin", "cgi-bin",
    )
)

RULES = T.StructType([T.StructField("action", T.StringType()), T.StructField("rule", T.StringType())])


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """A list of rules as a table with columns action and rule."""
    return spark.createDataFrame([(r.action, r.text) for r in rules], RULES)


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def address(url: Column) -> Column:
    """What follows the first `://`, the host in lower case; null without one."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.concat(_lower(host), F.substring(rest, F.length(host) + 1, F.length(rest)))


def host(address: Column) -> Column:
    return F.coalesce(F.regexp_extract(address, "^[^/?#]*", 0), F.lit(""))


def path(address: Column) -> Column:
    return F.coalesce(F.regexp_extract(address, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """The distinct runs of letters and digits, in lower case."""
    return F.array_distinct(F.regexp_extract_all(_lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def prepared(rules: DataFrame) -> DataFrame:
    """action, rule, site, expression and tokens of the rules in columns action and rule.

    Repeated rules count once; null rules and actions are dropped. The expression is for the
    address with a dot before it.
    """
    rule = F.col("rule")
    site = ~rule.rlike(r"[\^*]")
    # Signs with a meaning in expressions are escaped; then * and ^ get theirs.
    literal = F.regexp_replace(rule, r"([\\.+?()\[\]{}|$^*#&~-])", r"\\$1")
    anywhere = F.regexp_replace(F.regexp_replace(literal, r"\\\*", ".*"), r"\\\^", "(?:[^a-z0-9]|\\$)")
    expression = F.when(site, F.concat(F.lit(r"^[^/?#]*\."), literal)).otherwise(F.concat(F.lit("(?is)"), anywhere))
    # A site rule starts after a dot and is open at its end; a pattern is open at both ends.
    framed = F.when(site, F.concat(F.lit("."), rule)).otherwise(rule)
    bounded = F.regexp_extract_all(_lower(framed), F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0))
    return (
        rules.select("action", "rule").dropna().distinct()
        .select("action", "rule", site.alias("site"), expression.alias("expression"), F.array_distinct(bounded).alias("tokens"))
    )


def rule_index(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """token, action, rule, site, expression: each rule under the one of its tokens that the fewest addresses hold.

    `rules` as `prepared`; `addresses` has distinct values in column address. Equal counts
    are settled by the token's order, a rule without tokens stands under EVERY.
    """
    asked = rules.select(F.explode("tokens").alias("token")).distinct()
    held = addresses.select(F.explode(tokens(F.col("address"))).alias("token"))
    counts = held.join(broadcast_if_small(asked), "token", "left_semi").groupBy("token").count()
    by_rule = rules.select("action", "rule", "site", "expression", F.explode_outer("tokens").alias("token"))
    ranked = by_rule.join(counts, "token", "left").withColumn("rank", F.struct(F.coalesce("count", F.lit(0)), "token"))
    return ranked.groupBy("action", "rule", "site", "expression").agg(
        F.coalesce(F.min(F.when(F.col("token").isNotNull(), F.col("rank")))["token"], F.lit(EVERY)).alias("token")
    )


def fitting(addresses: DataFrame, index: DataFrame) -> DataFrame:
    """address, site, action, rule: the winning site rule and the winning pattern of each address that has one.

    The longest rule wins; of equally long ones a blocking one, then the first by code point.
    """
    asked = addresses.select("address", F.explode(F.array_append(tokens(F.col("address")), F.lit(EVERY))).alias("token"))
    fits = F.rlike(F.concat(F.lit("."), F.col("address")), F.col("expression"))
    found = asked.join(broadcast_if_small(index), "token").filter(fits)
    order = F.struct(-F.length("rule"), F.col("action") != "block", F.col("rule"))
    return (
        found.groupBy("address", "site").agg(F.min_by(F.struct("action", "rule"), order).alias("best"))
        .select("address", "site", "best.action", "best.rule")
    )


def judge(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """row (all columns of `pages`), host, path, rule, pattern, verdict: one row per page.

    `rule` is the longest site rule that fits, else null; `pattern` the longest pattern. The
    verdict is the rule's action, else the pattern's, else `default`. A null url, or one without
    `://`, has an empty host and path and meets no rule. Equal urls are judged once; repeated
    pages have a row each. Without rules, or without pages, nothing else changes.
    """
    spark = pages.sparkSession
    held = packed(pages, address=address(pages["url"]))
    addresses = materialize(held.filter("address is not null").select("address").distinct())
    index = materialize(rule_index(prepared(rules), addresses))
    best = fitting(addresses, index)
    pick = lambda column, site: F.max(F.when(F.col("site") == site, F.col(column)))
    verdicts = materialize(
        best.groupBy("address").agg(
            pick("rule", True).alias("rule"), pick("rule", False).alias("pattern"),
            F.coalesce(pick("action", True), pick("action", False)).alias("action"),
        )
        .withColumn("deal", F.lit(0))
    )
    # Rows without an address have a key of their own each, so that they do not meet in one task.
    lost = F.col("address").isNull()
    deal = F.when(lost, 1 + F.pmod(F.xxhash64("row"), F.lit(DEALT))).otherwise(0).cast("int")
    held = held.select("row", F.coalesce("address", F.lit("")).alias("address"), deal.alias("deal"))
    joined = held.join(verdicts, ["address", "deal"], "left")
    return joined.select(
        "row", host(F.col("address")).alias("host"), path(F.col("address")).alias("path"), "rule", "pattern",
        F.coalesce("action", F.lit(default)).alias("verdict"),
    )
