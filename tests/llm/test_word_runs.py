"""Periodic runs beside a plain program."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import word_runs
from millrace.llm.queries import QUERIES
from millrace.llm.re_pair import re_pair

ROOT = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period): every period tried at every place."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)  # smaller periods come first
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repetitive(rng):
    """Words with repeats of many periods, cut anywhere."""
    letters, words = rng.choice([1, 2, 3, 5, 30]), []
    while len(words) < rng.randrange(0, 300):
        unit = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 13, 20, 31]))]
        words += unit * rng.choice([1, 1, 2, 3, 4, 8, 30])
        if rng.random() < 0.3 and len(words) > len(unit):
            words = words[: len(words) - rng.randrange(len(unit) + 1)]
    return words * 3 if rng.random() < 0.3 else words


def checked(sequences):
    words = np.array(sum(sequences, []))
    firsts = np.cumsum([0, *map(len, sequences)])[:-1]
    want = [(s + o, s + o + length, q) for d, o in zip(sequences, firsts.tolist()) for s, length, q in plain_runs(d)]
    assert [tuple(r) for r in word_runs.all_runs(words, firsts).T.tolist()] == want
    return len(want)


def test_runs_of_many_sequences():
    rng, n = random.Random(11), 0
    for _ in range(150):
        sequences = [d for d in (repetitive(rng) for _ in range(rng.randrange(1, 6))) if d] or [[0]]
        if rng.random() < 0.5:
            sequences.append(list(sequences[0]))  # a copy shares its rules
        n += checked(sequences)
    assert n > 500


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=120), min_size=1, max_size=3), st.integers(1, 6))
def test_runs_of_short_alphabets(sequences, times):
    checked([s * times for s in sequences])


@pytest.mark.parametrize("words", [[0] * 23, [0] * 24, [0, 1] * 12, list(range(8)) * 3, list(range(9)) * 3, [*range(9)] * 3 + [0]])
def test_shortest_runs(words):
    checked([words])
    checked([words[:-1]])
    checked([[9, *words, 9], words[1:]])


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert checked([b]) > 50


def test_grammar_derives_its_places():
    rng = random.Random(3)
    sequences = [d for d in (repetitive(rng) for _ in range(40)) if d]
    words, firsts = np.array(sum(sequences, [])), np.cumsum([0, *map(len, sequences)])[:-1]
    rounds, symbols = re_pair(words, firsts, 1)
    assert set(firsts.tolist()) <= set(symbols.tolist()) and len(symbols) < len(words) // 2
    for rules in rounds:
        for k, length in enumerate(rules.length.tolist()):
            starts = rules.starts[rules.of == k]
            assert len(starts) > 1 and rules.left[k] < length
            assert (np.diff(starts) >= length).all()
            assert len({tuple(words[s : s + length].tolist()) for s in starts.tolist()}) == 1


def test_very_long_texts():
    for words, run in ([[0] * 400_000, (0, 400_000, 1)], [[x for i in range(60_000) for x in (i % 5000 + 2, 0, 1)], (0, 180_000, 15_000)]):
        assert [tuple(r) for r in word_runs.all_runs(np.array(words), np.array([0])).T.tolist()] == [run]


ODD = [
    (1, None, 1), (2, "", 2), (3, " \n\t ", 3), (None, "na " * 30, 4), (None, "na " * 30, 4), (4, "é 漢 字 \x00 " * 9 + "end", 5),
    (4, "x " * 23, 6), (5, "a b " * 12 + "\x0b\x0c\r" + "c " * 24, 7),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, runs int")
    got = word_runs.collapse_runs(docs).collect()
    assert len(got) == len(ODD)
    want = []
    for doc_id, text, _ in ODD:
        words = split(text)
        runs = plain_runs(words)
        want.append((str(doc_id), len(words), runs, plain_collapse(words, runs)))
    assert sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == sorted(want)
    assert word_runs.collapse_runs(docs.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    rows = pq.read_table(f"{ROOT}/documents.parquet").to_pylist()
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, ROOT).toArrow().to_pylist()}
    assert len(got) == len(rows)
    planted = 0
    for d in rows:
        words = split(d["text"])
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        r = got[d["doc_id"]]
        top = None
        for run in runs:
            if top is None or run[1] * top[2] > top[1] * run[2]:
                top = run
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (top or (None, None, None))
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if top else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert planted > 5 and any(r["n_runs"] for r in got.values())
