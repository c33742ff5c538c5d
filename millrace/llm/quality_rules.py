"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
long of failure bits; policies are versioned masks over those bits, so a new policy or
an ablation is bit arithmetic over the ledger and never reads a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import words


@dataclass(frozen=True)
class Rule:
    """`failed` is built from the measurement columns; `bit` is never reused."""

    bit: int
    name: str
    failed: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules. A document is kept when none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule]) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[n] for n in self.rules)


RULES = [
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_words", lambda: F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
    Rule(2, "short_words", lambda: F.col("word_chars") < F.col("n_words") * 3),
    Rule(3, "long_words", lambda: F.col("word_chars") > F.col("n_words") * 12),
    Rule(4, "symbols", lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    # A line that occurs twice in a text of three is no sign yet.
    Rule(5, "duplicate_lines", lambda: (F.col("n_dup_lines") > 2) & (F.col("n_dup_lines") * 10 > F.col("n_lines") * 3)),
    Rule(6, "few_letters", lambda: F.col("n_letters") * 10 < F.col("word_chars") * 6),
    Rule(7, "shouting", lambda: F.col("n_capitals") * 2 > F.col("n_letters")),
    Rule(8, "bullet_lines", lambda: F.col("n_bullet_lines") * 10 > F.col("n_lines") * 9),
    Rule(9, "cut_lines", lambda: F.col("n_cut_lines") * 10 > F.col("n_lines") * 3),
]

BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = [
    BASE,
    Policy("standard", 1, ("few_words", "repeated_words", "symbols", "duplicate_lines", "few_letters")),
    Policy("standard", 2, tuple(r.name for r in RULES)),
]
STANDARD = POLICIES[-1]

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_bullet_lines", "n_cut_lines",
)


def _covered(places: Column, width: int) -> Column:
    """Words under the windows that start at the sorted `places`."""
    steps = F.transform(places, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - p, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def measure(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = 3) -> DataFrame:
    """The `keep` columns and one long per measurement, one row per input row.

    A null text counts as empty: all measurements are 0. Repeated rows are measured
    each for itself. A repeated window is found by its 64-bit hash within one document;
    windows are sorted inside the row, so no row leaves its task.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    start = docs.select(*[docs[c].alias(f"keep_{i}") for i, c in enumerate(keep)], docs[text].alias("text"))
    kept = [f"keep_{i}" for i in range(len(keep))]
    # Each step is a projection of its own, so that no array is built twice.
    split = start.select(
        *kept,
        words(body).alias("words"),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace(body, r"\P{L}+", "")).alias("n_letters"),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).alias("n_capitals"),
    )
    size = F.size("words")
    hashed = lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(window)])
    grams = F.when(
        size >= window,
        F.sort_array(
            F.transform(F.sequence(F.lit(0), size - window), lambda i: F.struct(hashed(i).alias("h"), i.alias("i")))
        ),
    )
    lines = split.select(
        *kept, "n_symbols", "n_letters", "n_capitals",
        size.alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("lines", lambda s: s.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_cut_lines"),
        grams.alias("grams"),
    )
    at = lambda k: F.get(F.col("grams"), k)["h"]
    twice = F.filter("grams", lambda g, k: (g["h"] == at(k - 1)) | (g["h"] == at(k + 1)))
    placed = lines.withColumn("places", F.sort_array(F.transform(twice, lambda g: g["i"]))).drop("grams")
    done = placed.withColumn(
        "n_repeat_words", F.coalesce(_covered(F.col("places"), window), F.lit(0))
    )
    return done.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], *[F.col(m).cast("long").alias(m) for m in MEASURES]
    )


def ledger(measured: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """`measured` with `fail_bits`: bit b is set when the rule of bit b failed."""
    bits = [F.when(r.failed(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total)


def passes(policy: Policy, rules: list[Rule] = RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablation(rows: DataFrame, policies: list[Policy] = POLICIES, rules: list[Rule] = RULES) -> DataFrame:
    """What each rule of each policy does, from the ledger alone.

    policy, version, rule, failed (documents that fail the rule), rejected (by the
    policy), alone (rejected by this rule only: they return when it is left out). Equal
    bit patterns are counted first, so the shuffle carries patterns and not documents.
    An empty ledger gives zeros.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    bits = {r.name: 1 << r.bit for r in rules}
    n = F.col("n")
    entries = []
    for p in policies:
        masked = F.col("fail_bits").bitwiseAND(F.lit(p.mask(rules)).cast("long"))
        for name in p.rules:
            hit = masked.bitwiseAND(F.lit(bits[name]).cast("long")) != 0
            entries.append((p, name, [hit, masked != 0, masked == bits[name]]))
    sums = [
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
            *[F.coalesce(F.sum(F.when(t, n)), F.lit(0)).cast("long").alias(a)
              for t, a in zip(tests, ("failed", "rejected", "alone"))],
        )
        for p, name, tests in entries
    ]
    return patterns.agg(F.array(*sums).alias("e")).select(F.explode("e").alias("e")).select("e.*")
