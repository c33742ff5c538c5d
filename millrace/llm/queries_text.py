"""Queries of the operators that stay in the row: quality rules, lines, mixing, secrets."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import line_spread, mixing, quality_rules, secret_scan
from millrace.llm.registry import query
from millrace.session import Tables

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

OP1_SQL = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, doc_id, t, regexp_extract_all(t, '{WORD}') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as l from d),
g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
      from (select r, w, unnest(range(1, len(w) - 1)) as i from w)),
p as (select r, i from (select *, count(*) over (partition by r, g) as n from g) where n > 1),
c as (select r, sum(least(3, coalesce(nxt - i, 3))) as n from
      (select r, i, lead(i) over (partition by r order by i) as nxt from p) group by r),
m as (select doc_id, len(w)::bigint as n_words, coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
        len(l)::bigint as n_lines, length(regexp_replace(t, '\P{{L}}+', '', 'g'))::bigint as n_letters,
        length(regexp_replace(t, '\P{{Lu}}+', '', 'g'))::bigint as n_capitals,
        len(list_filter(l, lambda x: regexp_matches(x, '^{SPACE}*[-*•]')))::bigint as n_bullet_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…){SPACE}*$')))::bigint as n_cut_lines
      from w left join c using (r)),
b as (select *, (case when n_words < 50 then 1 else 0 end)
        + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
        + (case when word_chars < 3 * n_words then 4 else 0 end)
        + (case when word_chars > 12 * n_words then 8 else 0 end)
        + (case when 10 * n_symbols > n_words then 16 else 0 end)
        + (case when n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines then 32 else 0 end)
        + (case when 10 * n_letters < 6 * word_chars then 64 else 0 end)
        + (case when 2 * n_capitals > n_letters then 128 else 0 end)
        + (case when 10 * n_bullet_lines > 9 * n_lines then 256 else 0 end)
        + (case when 10 * n_cut_lines > 3 * n_lines then 512 else 0 end) as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits::bigint as fail_bits,
  (bits & 3) <> 0 as base_failed, bits = 0 as kept from b
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(t: Tables):
    rows = quality_rules.ledger(quality_rules.measure(t.documents))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.STANDARD).alias("kept"),
    )


KIND_SQL = """select doc_id, n, '{kind}' as kind, {order} as k, pos as s, pos + length(p) as e from (
  select *, coalesce(sum(length(p)) over (partition by n order by i rows between unbounded preceding and 1 preceding), 0) as pos
  from (select n, doc_id, unnest(x) as p, generate_subscripts(x, 1) as i
        from (select n, doc_id, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) as x from d)))
where i % 2 = 0 and {keep}"""
KEEP_SQL = {
    "assign": "length(regexp_extract(p, '{pattern}', 2)) >= 6",
    "access": "length(p) >= 20",
}


def _op4_sql() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("'", "''")
        keep = KEEP_SQL.get(r.kind, "true").format(pattern=pattern)
        parts.append(KIND_SQL.format(kind=r.kind, order=i, pattern=pattern, keep=keep))
    spelled = "string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, k)"
    return f"""
with d as (select row_number() over () as n, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) as t from documents),
m as ({" union all ".join(parts)}),
g as (select n, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
  {spelled} filter (k < 3) as base, {spelled} as spans from m group by n)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join g using (n)
"""


@query("op4_secret_scan", _op4_sql())
def op4_secret_scan(t: Tables):
    found = secret_scan.scan(t.documents.select("doc_id", "text"))
    spans = F.col("spans")
    of = lambda i: F.size(F.filter(spans, lambda s: s["order"] == i)).cast("long")
    base = F.filter(spans, lambda s: s["order"] < 3)
    return found.select(
        F.col("row.doc_id"), of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secret_scan.spelled(base), 256).alias("base_sha256"), secret_scan.spelled(spans).alias("spans"),
    )


MIX_SQL = """
with recursive d as (select doc_id, coalesce('s' || source, 't') as q, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
  ('0x' || substr(md5('5:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as place from documents),
s as (select q, sum(size)::bigint as source_size, row_number() over (order by q) - 1 as rank from d group by q),
w as (select q, source_size, 3 * source_size as cap, ([5, 2, 1])[(rank % 3 + 1)::int] as weight from s),
v as (select *, (sum(source_size) over () - coalesce(sum(cap) over o, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over o, 0))::double as level
  from w window o as (order by cap::double / weight, q rows between unbounded preceding and 1 preceding)),
c as (select arg_min(level, (cap::double / weight, q)) as common from v where level * weight <= cap),
t as (select q, source_size, least(cap::double, common * weight) as target from w, c),
u as (select d.doc_id, d.size, t.source_size, t.target, sum(size) over (partition by q order by place, doc_id, size rows unbounded preceding) as before_end
  from d join t using (q)),
f as (select size, (source_size * e + before_end)::double / target as finish from u, (values (0), (1), (2)) x(e) where size > 0),
k as (select max(finish) as cut from (select finish, sum(size) over (order by finish range unbounded preceding) as spent from f)
  where spent <= (select sum(size) from d))
"""
OP5_SQL = (
    MIX_SQL
    + """select doc_id, size, source_size, target, case when size = 0 then 0 else (size * (
  (case when before_end::double / target <= cut then 1 else 0 end)
  + (case when (source_size + before_end)::double / target <= cut then 1 else 0 end)
  + (case when (source_size * 2 + before_end)::double / target <= cut then 1 else 0 end))) end::bigint as taken from u, k
"""
)


@query("op5_source_mix", OP5_SQL)
def op5_source_mix(t: Tables):
    return mixing.mix(t.documents).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = f"""
with d as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as ls from documents),
l as (select r, doc_id, source, unnest(ls) as raw, generate_subscripts(ls, 1) as i from d),
x as (select *, regexp_replace(raw, '^{SPACE}+|{SPACE}+$', '', 'g') as line from l),
b as (select line, min((doc_id, i)) as first from x where line <> '' group by line having count(distinct source) >= {line_spread.MIN_SITES}),
k as (select x.*, b.line is not null and (x.doc_id, x.i) <> b.first as gone from x left join b using (line)),
g as (select r, count(*) as n_lines, count(*) filter (gone) as n_removed,
  string_agg(raw, chr(10) order by i) filter (not gone) as clean from k group by r)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(case when text is null then null else coalesce(clean, '') end) as clean_sha256 from d left join g using (r)
"""


@query("op7_line_dedup", OP7_SQL)
def op7_line_dedup(t: Tables):
    done = line_spread.dedup_lines(t.documents.select("doc_id", "source", "text"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("clean", 256).alias("clean_sha256"))
