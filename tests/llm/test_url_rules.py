"""URL rules beside a plain program that tries every rule on every address."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import url_rules
from millrace.llm.url_rules import Rule


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split(url):
    if url is None or "://" not in url:
        return None, "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host) + rest[len(host) :], lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def matches(rule, address, host, path):
    """By walking the signs of the rule, without regular expressions."""
    if "^" not in rule and "*" not in rule:
        want, slash, rest = rule.partition("/")
        return ("." + host).endswith("." + want) and path.startswith(slash + rest)
    text = lower("." + address)

    def from_(i, k):
        if i == len(rule):
            return True
        c = rule[i]
        if c == "*":
            return any(from_(i + 1, m) for m in range(k, len(text) + 1))
        if c == "^":
            end = k == len(text)
            return (end and from_(i + 1, k)) or (not end and not re.match("[a-z0-9]", text[k]) and from_(i + 1, k + 1))
        return k < len(text) and text[k] == lower(c) and from_(i + 1, k + 1)

    return any(from_(0, k) for k in range(len(text) + 1))


def plain(url, rules, default="allow"):
    address, host, path = split(url)
    best = {}
    if address is not None:
        for r in rules:
            site = not re.search(r"[\^*]", r.text)
            if matches(r.text, address, host, path):
                order = (-len(r.text), r.action != "block", r.text)
                best[site] = min(best.get(site, (order, r)), (order, r), key=lambda x: x[0])
    site, pattern = (best[k][1] if k in best else None for k in (True, False))
    verdict = site.action if site else pattern.action if pattern else default
    return host, path, site.text if site else None, pattern.text if pattern else None, verdict


ODD = [
    None, "", "no address", "://", "http://", "HTTP://WWW.Example.ORG/ES/x", "http://example.org/es/x", "http://a.example.org/en/1",
    "http://badexample.org/es/x", "http://org", "http://org/", "http://x.org?es/", "http://x.org#/es/", "http://u@x.com/fr/1",
    "http://x.com:80/fr/1", "http://x.com/fr", "http://x.com/FR/", "ftp://x://y.org/", "http://cheap-pills.example.net/en/1",
    "http://cheap-PILLS.net", "http://spills.net/en", "http://x.net/en?next=casino", "http://x.net/casino9", "http://casino.org/en/2",
    "http://é.org/漢字\n/x", "http://x.net/" + "a/" * 5000 + "poker", "x" * 20000,
]
RULES = url_rules.SITES + url_rules.PATTERNS


def rows(df):
    return sorted(
        (str(r["row"]["page_id"]), r["row"]["url"] or "", r["host"], r["path"], str(r["rule"]), str(r["pattern"]), r["verdict"])
        for r in df.collect()
    )


def wanted(urls, rules, **kw):
    return sorted((str(i), u or "", *[str(x) for x in plain(u, rules, **kw)]) for i, u in urls)


def frame(spark, urls):
    """Pages with extra columns that have the operator's own names."""
    return spark.createDataFrame([(i, u, "h", "t", 1) for i, u in urls], "page_id long, url string, host string, token string, deal int")


def test_odd_addresses(spark):
    urls = [*enumerate(ODD), (None, "http://org/"), (None, "http://org/"), (7, None), (7, None)]
    assert rows(url_rules.judge(frame(spark, urls), url_rules.rule_table(spark, RULES))) == wanted(urls, RULES)


def test_no_pages_and_no_rules(spark):
    some, none = frame(spark, [*enumerate(ODD)]), url_rules.rule_table(spark, ())
    assert rows(url_rules.judge(some.limit(0), url_rules.rule_table(spark, RULES))) == []
    assert {r["verdict"] for r in url_rules.judge(some, none, default="block").collect()} == {"block"}


def test_random_rules(spark):
    rng = random.Random(6)
    parts = ["a", "b", "ab", "x-y", "org", "1", "12", "A"]
    urls = [
        (i, "http://" + ".".join(rng.choices(parts, k=rng.randrange(1, 4))) + "".join(rng.choice("/?#.") + rng.choice(parts) for _ in range(rng.randrange(4))))
        for i in range(400)
    ]
    rules = [Rule(rng.choice(["allow", "block"]), ".".join(rng.choices(["a", "b", "ab", "org"], k=2)) + "/" + rng.choice(["", "a", "1", "x-y/"])) for _ in range(40)]
    rules += [Rule(rng.choice(["allow", "block"]), "".join(rng.choices(["^", "*", "a", "b", "1", ".", "-", "/", "Ab"], k=rng.randrange(2, 6))) + "^") for _ in range(60)]
    table = url_rules.rule_table(spark, tuple(rules))
    doubled = table.unionByName(table).unionByName(spark.createDataFrame([(None, "a/"), ("block", None)], table.schema))
    assert rows(url_rules.judge(frame(spark, urls), doubled)) == wanted(urls, rules)


def test_rarest_token_leads(spark):
    addresses = spark.createDataFrame([(f"h{i}.example.org/en/{i}",) for i in range(50)] + [("x.example.org/es/1",)], "address string")
    rules = url_rules.prepared(url_rules.rule_table(spark, (*RULES, Rule("block", "*z*"), Rule("block", "exam"))))
    index = {r["rule"]: r["token"] for r in url_rules.rule_index(rules, addresses).collect()}
    assert index["example.org/es/"] == "es" and index["org/"] == "org" and index["^cart^"] == "cart"
    assert index["example.org/en/1"] == "en"  # 1 may go on; 50 addresses hold en, 51 example and org
    assert index["*z*"] == index["exam"] == url_rules.EVERY
    # Only candidates meet an expression: as many pairs as addresses that hold the rule's token.
    asked = addresses.select("address", F.explode(url_rules.tokens(F.col("address"))).alias("token"))
    assert asked.filter("token = 'es'").count() == 1


@pytest.mark.parametrize("limit", [0, 50_000])
def test_large_rule_lists_meet_by_shuffle(spark, monkeypatch, limit):
    """The same rows whether the index is broadcast or not."""
    from millrace.operators import sizing

    monkeypatch.setattr(url_rules, "broadcast_if_small", lambda df: sizing.broadcast_if_small(df, limit))
    urls = [(i, f"http://h{i % 7}.example.{'org' if i % 3 else 'com'}/{'es' if i % 2 else 'fr'}/{i}") for i in range(500)]
    assert rows(url_rules.judge(frame(spark, urls), url_rules.rule_table(spark, RULES))) == wanted(urls, RULES)


def test_urls_run_no_python(spark):
    judged = url_rules.judge(frame(spark, [*enumerate(ODD)]), url_rules.rule_table(spark, RULES))
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
