"""Re-Pair over many word sequences at once, in rounds of NumPy operations.

A round replaces, all at the same time, every pair of neighbours that is more frequent
than the pairs it overlaps; a pair that stays alone is left. That is Re-Pair's order
wherever it matters, in about as many rounds as the longest repeat has levels. Sequences
share the rules, no pair reaches from one into the next.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: An odd number with well mixed bits.
SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Rules:
    """The rules of one round: rule k derives `length[k]` words, the first `left[k]` from its left symbol.

    `starts` holds where each derivation of the rules begins, `of` the rule of each; both in
    order of place, so a rule's first derivation comes first.
    """

    left: np.ndarray
    length: np.ndarray
    starts: np.ndarray
    of: np.ndarray


def re_pair(words: np.ndarray, firsts: np.ndarray, least: int) -> tuple[list[Rules], np.ndarray]:
    """The rounds, with only the rules of at least `least` words, and where the symbols left over start.

    `words` are small whole numbers, `firsts` the places where a new sequence begins.
    """
    n = len(words)
    symbol = words.astype(np.int64)
    start = np.arange(n)
    opens = np.zeros(n + 1, bool)  # a sequence begins here
    opens[firsts] = True
    opens[n] = True
    size = np.ones(n, np.int64)
    fresh = int(symbol.max(initial=-1)) + 1
    live = np.ones(n, bool)  # the pair that begins here may occur twice
    rounds = []
    while True:
        at = np.flatnonzero(live[:-1] & ~opens[start[1:]]) if len(symbol) > 1 else np.empty(0, np.int64)
        a, b = symbol[at], symbol[at + 1]
        free = _every_other(at, a == b)
        at, a, b = at[free], a[free], b[free]
        codes, pair, count = np.unique(a * fresh + b, return_inverse=True, return_counts=True)
        rank = np.empty(len(codes), np.int64)
        # Equal counts rank by a scrambled code, so that chains of growing codes need few rounds.
        scrambled = codes.view(np.uint64) * SCRAMBLE
        rank[np.lexsort((scrambled, count))] = np.arange(1, len(codes) + 1)
        twice = count[pair] > 1
        at, pair = at[twice], pair[twice]
        if not len(at):
            return rounds, start
        weight = rank[pair]
        near = np.diff(at) == 1
        wins = np.ones(len(at), bool)
        wins[:-1] &= ~near | (weight[:-1] > weight[1:])
        wins[1:] &= ~near | (weight[1:] > weight[:-1])
        kept = np.bincount(pair[wins], minlength=len(codes))
        wins &= kept[pair] > 1
        live[:] = False
        live[at] = True
        at, pair = at[wins], pair[wins]
        used, rule = np.unique(pair, return_inverse=True)
        long = size[at] + size[at + 1] >= least
        if long.any():
            rounds.append(_rules(rule[long], size[at][long], (size[at] + size[at + 1])[long], start[at][long]))
        symbol[at] = fresh + rule
        size[at] += size[at + 1]
        fresh += len(used)
        live[at] = True
        live[np.maximum(at - 1, 0)] = True
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        symbol, size, start, live = symbol[stay], size[stay], start[stay], live[stay]


def _every_other(at: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Of a pair of equal symbols that overlaps itself, every second occurrence; all others."""
    free = np.ones(len(at), bool)
    i = np.flatnonzero(twin)
    if len(i):
        head = np.r_[True, np.diff(at[i]) != 1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(i)), 0))
        free[i[(np.arange(len(i)) - first) % 2 == 1]] = False
    return free


def _rules(rule: np.ndarray, left: np.ndarray, length: np.ndarray, starts: np.ndarray) -> Rules:
    _, first, of = np.unique(rule, return_index=True, return_inverse=True)
    return Rules(left[first], length[first], starts, of)
