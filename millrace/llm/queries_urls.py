"""The query of the URL filter, with its SQL."""

from __future__ import annotations

from millrace.llm import url_rules
from millrace.llm.registry import query
from millrace.session import Tables


def _op11_sql() -> str:
    """Every rule tried on every address, the longest site rule first, then the patterns."""
    fits = []
    for r in sorted(url_rules.SITES, key=lambda r: -len(r.text)):
        host, _, path = r.text.partition("/")
        fits.append((f"('.' || host) like '%.{host}' and starts_with(path, '/{path}')", r))
    rule = " ".join(f"when {c} then '{r.text}'" for c, r in fits)
    action = " ".join(f"when {c} then '{r.action}'" for c, r in fits)
    patterns = "|".join(r.text.strip("^") for r in url_rules.PATTERNS)
    return rf"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages),
a as (select page_id, coalesce(rest, '') as rest,
  translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') as host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u)
select page_id, host, path, case {rule} end as rule,
  case {action} when regexp_matches(translate('.' || rest, '{url_rules.UPPER}', '{url_rules.LOWER}'), '[^a-z0-9]({patterns})([^a-z0-9]|$)')
    then 'block' else 'allow' end as verdict
from a
"""


@query("op11_url_filter", _op11_sql())
def op11_url_filter(t: Tables):
    rules = url_rules.rule_table(t.spark, url_rules.SITES + url_rules.PATTERNS)
    judged = url_rules.judge(t.pages.select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")
