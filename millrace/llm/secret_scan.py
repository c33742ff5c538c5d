"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams: a text can
match only if it holds all trigrams of at least one of the query's clauses. Postings are
kept for the trigrams that some query names; intersecting them gives each rule's
candidates, and only those are scanned with the expression. A rule without a mandatory
trigram scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import packed
from millrace.operators.lineage import materialize


@dataclass(frozen=True)
class Rule:
    """`keep` filters a match, given the matched text; None keeps all."""

    kind: str
    pattern: str
    keep: object = None
    base: bool = False


# The base rules and their least lengths; then public token formats.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = [
    Rule("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6, True),
    Rule("access", "AKIA[A-Z0-9]+", lambda m: F.length(m) >= 20, True),
    Rule("hex", "[0-9a-f]{24,}", None, True),
    Rule("private", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
]

#: Strings that an expression is expanded into before they are reduced to trigrams.
MOST_STRINGS = 256
#: Slots of the index that share one bitmap.
BUCKET = 32_768
#: Bytes of candidate bitmaps that are broadcast at most; beyond, they are joined.
BROADCAST_BYTES = 64 << 20

Query = frozenset  # of clauses; a clause is a frozenset of trigrams, all of which must occur


def _chars(op, arg) -> set[str] | None:
    """The characters of a single-character node when they are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and all(k in (sre.LITERAL, sre.RANGE) for k, _ in arg):
        spans = [(a, a) if k is sre.LITERAL else a for k, a in arg]
        if sum(b - a + 1 for a, b in spans) <= 8:
            return {chr(c).lower() for a, b in spans for c in range(a, b + 1)}
    return None


def _strings(nodes) -> list:
    """The expression as a list of string sets; None stands for text that is not known."""
    out: list = []
    for op, arg in nodes:
        if (chars := _chars(op, arg)) is not None:
            out.append(chars)
        elif op is sre.SUBPATTERN:
            out += _strings(arg[-1])
        elif op is sre.BRANCH:
            ways = [_joined(_strings(way)) for way in arg[1]]
            out.append(set().union(*ways) if all(w is not None for w in ways) else None)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == arg[1]:
            out += _strings(list(arg[2]) * arg[0])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[:2] == (0, 1):
            inner = _joined(_strings(arg[2]))
            out.append(inner | {""} if inner is not None else None)
        else:
            out.append(None)
    return out


def _joined(parts: list) -> set[str] | None:
    """All strings of a run of known parts; None if a part is not known or they are many."""
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in p}
    return out


def _clauses(strings: set[str]) -> Query | None:
    if any(len(s) < 3 for s in strings):
        return None
    every = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return frozenset(c for c in every if not any(d < c for d in every))


def trigram_query(pattern: str) -> Query | None:
    """Clauses of lower-case trigrams, one of which a matching text must hold; None: no such clause.

    Known strings are joined as far as they are bounded; of the runs between unknown
    text, the one with the fewest clauses is taken, and a run whose shortest string has
    under three characters says nothing.
    """
    runs: list[set[str]] = [{""}]
    for part in _strings(sre_parse.parse(pattern)):
        if part is None:
            runs.append({""})
        elif (longer := _joined([runs[-1], part])) is None:
            runs.append(part)
        else:
            runs[-1] = longer
    found = [q for q in map(_clauses, runs) if q]
    return min(found, key=lambda q: (len(q), -min(map(len, q)))) if found else None


def _has(postings: Column, query: Query) -> Column:
    """Whether the array of trigrams of one slot satisfies the query."""
    ways = [F.size(F.array_intersect(postings, F.array(*[F.lit(g) for g in sorted(c)]))) == len(c) for c in sorted(query, key=sorted)]
    out = ways[0]
    for w in ways[1:]:
        out = out | w
    return out


def postings(docs: DataFrame, queries: dict[str, Query], slots: int) -> DataFrame:
    """The inverted index: trigram, slot. Rows for the trigrams that the queries name.

    A slot is a hash of the id, so slots are dense whatever the ids are; documents that
    share one only give each other candidates. A null text has no postings.
    """
    named = sorted({g for q in queries.values() for c in q for g in c})
    low = docs.select(_slot(docs["doc_id"], slots).alias("slot"), F.lower(docs["text"]).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in named]))
    return low.select("slot", F.explode(held).alias("trigram"))


def _slot(doc_id: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(slots))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """bucket and, for each rule, the bitmap of the slots whose postings satisfy its query."""
    dealt = index.withColumn("bucket", F.floor(F.col("slot") / BUCKET).cast("long")).repartition("bucket")
    gathered = dealt.groupBy("bucket", "slot").agg(F.collect_set("trigram").alias("held"))
    tested = gathered.select("bucket", (F.col("slot") % BUCKET).alias("bit"), *[_has(F.col("held"), q).alias(k) for k, q in queries.items()])
    some = F.expr(" or ".join(queries))
    bitmaps = [F.expr(f"bitmap_construct_agg(bit) filter (where {k})").alias(k) for k in queries]
    return tested.filter(some).groupBy("bucket").agg(*bitmaps)


def _bit(bitmap: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce((byte / F.pow(F.lit(2), bit % 8)).cast("int") % 2 == 1, F.lit(False))


def _running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of numbers: sums over 1, 2, 4, ... values, each from two of the step before."""
    shifts = F.array(*[F.lit(1 << k) for k in range(30)])

    def step(sums: Column, d: Column) -> Column:
        more = F.transform(sums, lambda x, i: x + F.when(i >= d, F.get(sums, i - d)).otherwise(0))
        return F.when(d < F.size(sums), more).otherwise(sums)

    return F.aggregate(shifts, values, step)


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """start, order, end of each match, by start.

    Matches are fenced with a control character and the text is split there, so every
    second piece is a match; running sums of the lengths give the places. The pieces are
    bound to a variable of a one-element array, so they are made once.
    """
    pieces = F.split(F.regexp_replace(text, rule.pattern, "\u0001$0\u0001"), "\u0001", -1)
    ends = lambda p: F.struct(p.alias("pieces"), _running_sums(F.transform(p, lambda x: F.length(x))).alias("ends"))

    def spans(v: Column) -> Column:
        def one(piece: Column, i: Column) -> Column:
            wanted = (i % 2 == 1) if rule.keep is None else (i % 2 == 1) & rule.keep(piece)
            end = F.get(v["ends"], i)
            return F.when(wanted, F.struct((end - F.length(piece)).alias("start"), F.lit(order).alias("order"), end.alias("end")))

        return F.array_compact(F.transform(v["pieces"], one))

    return F.flatten(F.transform(F.transform(F.array(pieces), ends), spans))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """row (the input row), and spans: array of (start, order, end), sorted.

    Places are code points, the end exclusive; order is the rule's place in `rules`. For
    one rule matches are leftmost and do not overlap; different rules may. A null or
    empty text has no spans, an empty table gives no rows. The cost grows with the number
    of matches and its logarithm, also within one text. Rows that repeat an id are scanned each for itself; a null
    id is indexed like any other.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    n = docs.count()
    buckets = -(-2 * max(n, 1) // BUCKET)
    slots = buckets * BUCKET
    whole = packed(
        docs,
        # The fence must not occur in a text. Its stand-in is as long and in no rule's alphabet.
        text=F.translate(F.coalesce(docs["text"], F.lit("")), "\u0001", "\u0002"),
        bucket=F.floor(_slot(docs["doc_id"], slots) / BUCKET).cast("long"),
        bit=_slot(docs["doc_id"], slots) % BUCKET,
    )
    if queries:
        found = materialize(candidates(postings(docs, queries, slots), queries))
        small = buckets * (BUCKET // 8) * len(queries) <= BROADCAST_BYTES
        whole = whole.join(F.broadcast(found) if small else found, "bucket", "left")
    marked = whole.select("row", "text", *[(_bit(r.kind, F.col("bit")) if r.kind in queries else F.lit(True)).alias(r.kind) for r in rules])
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    found = [F.when(F.col(r.kind) & F.col("text").rlike(r.pattern), _spans(r, i, F.col("text"))).otherwise(none) for i, r in enumerate(rules)]
    return marked.select("row", F.sort_array(F.concat(*found)).alias("spans"))


def spelled(spans: Column, rules: list[Rule] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")

