"""Runs of repeated words in every document, found in a grammar of the words.

The words of a batch of documents are compressed by Re-Pair. A run lies across the
boundary of exactly one node of the derivation that holds it whole: of a rule, or between
two symbols left over. So the runs across each rule's boundary are computed once, where
the rule first occurs, carried to all its other places, and merged.

At a boundary a run of period q has at least half its words on one side. There a stretch
of g words comes back at distance q; g grows with q, so that few places come into
question. Names of repeated stretches of 1, 2, 4, ... words give these places and the exact
extent of a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import release, slices
from millrace.llm.re_pair import re_pair

#: Fewest words of a run, and fewest periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of a stretch that must come back for the shortest periods. A run of at least 24
#: words and 3 periods has this many at distance q on the longer side of any boundary.
LEAST_STRETCH = 4
#: Bytes of text that share a grammar; a longer text has its own.
BATCH_BYTES = 2 << 20
#: Places that are compared at a time.
AT_ONCE = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


class Stretches:
    """Names of the stretches of 1, 2, 4, ... words that occur twice in their sequence; -1 for all others."""

    def __init__(self, words: np.ndarray, sequence: np.ndarray):
        n = len(words)
        self.names: list[np.ndarray] = []
        self._keys: dict[int, np.ndarray] = {}
        at = np.arange(n)
        code = words.astype(np.int64) * (int(sequence.max(initial=0)) + 1) + sequence
        while len(at):
            _, name, count = np.unique(code, return_inverse=True, return_counts=True)
            twice = count[name] > 1
            at, name = at[twice], name[twice]
            if not len(at):
                break
            names = np.full(n, -1, np.int32)
            names[at] = name
            width = 1 << len(self.names)
            self.names.append(names)
            # A name holds its sequence, so a stretch of two names of one sequence cannot leave it.
            inside = at + width < n
            at = at[inside]
            after = names[at + width]
            both = (after >= 0) & (sequence[at] == sequence[np.minimum(at + width, n - 1)])
            at = at[both]
            code = names[at].astype(np.int64) * (int(name.max()) + 1) + after[both]

    def keys(self, level: int) -> np.ndarray:
        """Name and place of every stretch of that level as one number, sorted."""
        if level not in self._keys:
            names = self.names[level]
            places = np.flatnonzero(names >= 0)
            self._keys[level] = np.sort(names[places].astype(np.int64) * len(names) + places)
        return self._keys[level]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on."""
        return self._shared(i, j, 1)

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j."""
        return self._shared(i, j, -1)

    def _shared(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        total = np.zeros(len(i), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            width, names = 1 << level, self.names[level]
            a, b = (i + total, j + total) if way > 0 else (i - total - width, j - total - width)
            ok = (a >= 0) & (b >= 0) & (a < len(names)) & (b < len(names))
            x, y = names[np.where(ok, a, 0)], names[np.where(ok, b, 0)]
            total[ok & (x >= 0) & (x == y)] += width
        return total


def runs_across(stretches: Stretches, at: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(boundary, start, end, period) of the runs inside [low, high) that reach over the boundary before word `at`.

    A run is as long as its period allows inside the limits and has at least LEAST_WORDS
    words and LEAST_PERIODS periods; the period is its smallest.
    """
    found = [np.empty((4, 0), np.int64)]
    level = LEAST_STRETCH.bit_length() - 1
    while level < len(stretches.names):
        g = 1 << level
        shortest, longest = (1 if g == LEAST_STRETCH else 2 * g), 4 * g - 1
        names, keys = stretches.names[level], stretches.keys(level)
        n = len(names)
        # Places inside a run of a period up to g would only show multiples of that period.
        from_, to = at.copy(), at.copy()
        b, s, e, q = np.concatenate(found, 1)
        short = q <= g
        order = np.argsort((e - s)[short], kind="stable")
        from_[b[short][order]], to[b[short][order]] = s[short][order], e[short][order]
        left = at - g
        first = np.maximum(low, left - longest)
        last = np.minimum(left - shortest, np.where(from_ <= left, from_ - 1, n))
        found.append(_extended(stretches, keys, names, left, first, last, left >= low, at, low, high))
        first = np.maximum(at + shortest, np.where(to >= at + g, to - g + 1, 0))
        last = np.minimum(at + longest, high - g)
        found.append(_extended(stretches, keys, names, at, first, last, at + g <= high, at, low, high))
        level += 1
    return _smallest_period(np.concatenate(found, 1))


def _extended(stretches, keys, names, own, first, last, valid, at, low, high):
    """Runs seen from the stretches that equal the one at `own` and begin in [first, last]."""
    b = np.flatnonzero(valid & (first <= last))
    b = b[names[own[b]] >= 0]
    base = names[own[b]].astype(np.int64) * len(names)
    i = np.searchsorted(keys, base + first[b])
    count = np.searchsorted(keys, base + last[b], side="right") - i
    ends = np.cumsum(count)
    out = [np.empty((4, 0), np.int64)]
    done = 0
    while done < len(b):  # a few boundaries at a time, each with all its places
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + AT_ONCE, side="right")))
        c = count[done:stop]
        of = np.repeat(b[done:stop], c)
        place = keys[np.repeat(i[done:stop], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] % len(names)
        q = np.abs(own[of] - place)
        # Word x equals word x + q on both sides of `here`; `here` lies in the stretch or at its end.
        here = np.where(place < own[of], at[of] - q, at[of])
        ahead = np.minimum(stretches.ahead(here, here + q), high[of] - here - q)
        back = np.minimum(stretches.back(here, here + q), here - low[of])
        s, e = here - back, here + q + ahead
        good = (s < at[of]) & (e > at[of]) & (e - s >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q))
        out.append(np.unique(np.array([of, s, e, q])[:, good], axis=1))
        done = stop
    return np.concatenate(out, 1)


def _smallest_period(found: np.ndarray) -> np.ndarray:
    """One column per (.., start, end), the one of the smallest period; sorted."""
    found = found[:, np.lexsort(found[::-1])]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:-1, 1:] != found[:-1, :-1]).any(0)
    return found[:, new]


def all_runs(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """(start, end, period) of every run of the sequences that begin at `firsts`, by start, then period.

    Sequences lie one after the other in `words`; `firsts` begins with 0 and none is empty.
    """
    n = len(words)
    if n < LEAST_WORDS:
        return np.empty((3, 0), np.int64)
    sequence = np.repeat(np.arange(len(firsts)), np.diff(np.r_[firsts, n]))
    stretches = Stretches(words, sequence)
    if len(stretches.names) < LEAST_STRETCH.bit_length():
        return np.empty((3, 0), np.int64)  # no stretch of that many words comes back anywhere
    rounds, symbols = re_pair(words, firsts, LEAST_WORDS)
    # Between symbols left over: inside the whole sequence.
    begins = firsts[sequence[symbols]]
    inner = symbols > begins
    at, low = symbols[inner], begins[inner]
    high = np.r_[firsts[1:], n][sequence[at]]
    found = [runs_across(stretches, at, low, high)[1:]]
    for rules in rounds:
        once = np.full(len(rules.length), n)
        np.minimum.at(once, rules.of, rules.starts)
        rule, s, e, q = runs_across(stretches, once + rules.left, once, once + rules.length)
        # Carried to all derivations of the rule.
        order = np.argsort(rules.of, kind="stable")
        uses = np.bincount(rules.of, minlength=len(once))
        skip = np.cumsum(uses) - uses
        c = uses[rule]
        shift = rules.starts[order[np.repeat(skip[rule], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)]]
        shift = shift - np.repeat(once[rule], c)
        found.append(np.array([np.repeat(s, c) + shift, np.repeat(e, c) + shift, np.repeat(q, c)]))
    return _merged(np.concatenate(found, 1), n)


def _merged(found: np.ndarray, n: int) -> np.ndarray:
    """Of the pieces of each period those that no other one contains, then one period per interval."""
    s, e, q = found[:, np.lexsort((-found[1], found[0], found[2]))]
    reach = np.r_[0, np.maximum.accumulate(q * (n + 1) + e)[:-1]]
    s, e, q = np.array([s, e, q])[:, q * (n + 1) + e > reach]
    s, e, q = _smallest_period(np.array([s, e, q]))
    return np.array([s, e, q])[:, np.lexsort((q, s))]


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number and text of each word: (word ids, number of the text, offsets, joined bytes). Null texts have none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    ends = ends - ends[0]
    letter = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    blank = np.r_[True, ~letter, True]
    starts = np.flatnonzero(letter & (blank[:-2] | edge[:-1]))
    stops = np.flatnonzero(letter & (blank[2:] | edge[1:])) + 1
    offsets = np.r_[0, np.cumsum(stops - starts)]
    joined = np.ascontiguousarray(raw[letter])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]
    )
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(starts) else np.empty(0, np.int32)
    return ids, np.searchsorted(ends, starts, side="right") - 1, offsets, joined


def join_words(keep: np.ndarray, of: np.ndarray, offsets: np.ndarray, joined: np.ndarray, n: int) -> pa.Array:
    """The kept words of each of n texts, joined by one blank."""
    word = np.flatnonzero(keep)
    size = offsets[word + 1] - offsets[word]
    last = np.r_[np.diff(of[word]) > 0, True][: len(word)]  # no blank after a text's last word
    step = size + ~last
    begin = np.cumsum(step) - step
    out = np.full(int(step.sum()), 32, np.uint8)
    out[np.repeat(begin, size) + _counts(size)] = joined[np.repeat(offsets[word], size) + _counts(size)]
    ends = np.r_[0, np.cumsum(np.bincount(of[word], step, n))].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends), pa.py_buffer(out)]).cast(pa.string())


def _counts(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ..., size - 1 for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _collapse(texts: pa.Array) -> list[pa.Array]:
    """Columns n_words, runs and collapsed of a few texts."""
    n = len(texts)
    ids, of, offsets, joined = split_words(texts)
    counts = np.bincount(of, minlength=n)
    begins = np.cumsum(counts) - counts
    s, e, q = all_runs(ids, begins[counts > 0])
    again = np.zeros(len(ids) + 1, np.int64)
    np.add.at(again, s + q, 1)
    np.add.at(again, e, -1)
    keep = np.cumsum(again[:-1]) == 0
    run_of = of[s]
    values = [pa.array(x) for x in (s - begins[run_of], e - s, q)]
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(run_of, minlength=n))], pa.int32())
    fields = [pa.field(f.name, pa.int64(), False) for f in RUN.fields]
    runs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(values, fields=fields))
    return [pa.array(counts.astype(np.int64)), runs, join_words(keep, of, offsets, joined, n)]


def collapse_runs(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns, n_words, runs and collapsed: one row per input row.

    `runs` are structs (start, length, period), counted in words from 0 and sorted by start,
    then period. `collapsed` joins by one blank the words that stay: of each run the first
    period, and all words outside. A null or empty text, or one of blanks, has no words, no
    runs and collapses to ''. Repeated rows each have their own; an empty table gives no rows.
    Other columns of `docs`, whatever their names, are not read.
    """
    kept = docs.select(*keep).schema.fields
    schema = T.StructType([
        *kept, T.StructField("n_words", T.LongType(), False), T.StructField("runs", T.ArrayType(RUN, False), False),
        T.StructField("collapsed", T.StringType(), False),
    ])
    names = schema.names

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(batch.num_columns - 1), BATCH_BYTES):
                own = batch.slice(at, len(part)).columns[:-1]
                at += len(part)
                yield pa.RecordBatch.from_arrays([*own, *_collapse(part)], names)
        release()

    return docs.select(*keep, F.coalesce(docs["text"], F.lit("")).alias("text")).mapInArrow(collapse, schema)
