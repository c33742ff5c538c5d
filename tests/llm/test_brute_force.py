"""Operators that SQL cannot express, beside plain programs over the smallest tables."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from millrace.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return sorted(pq.read_table(f"{ROOT}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])


def rows(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, ROOT).toArrow().to_pylist()}


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, linked):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash(spark, docs):
    got = rows(spark, "op8_simhash")
    want = [plain_fingerprint(d["text"]) for d in docs]
    roots = plain_components(want, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(got) == len(docs)
    for d, f, r in zip(docs, want, roots):
        assert got[d["doc_id"]]["fingerprint"] == f"{f:016x}"
        assert got[d["doc_id"]]["component_id"] == docs[r]["doc_id"]


def test_fingerprints(spark, docs):
    got = rows(spark, "op9_document_fingerprints")
    down = docs[::-1]
    assert len(got) == len(docs)
    by_text = {}
    for d, n in zip(down, down[1:] + down[:1]):
        r, k = got[d["doc_id"]], len(d["text"]) // 3
        new = d["text"][: len(d["text"]) - k] + n["text"][:k]
        assert r["n_chars"] == len(d["text"])
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(d["text"], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if d["text"] == n["text"]:
            assert r["near_next"] == 1
    long = [r for r in got.values() if r["n_chars"] > 1000]
    assert abs(np.mean([r["near_edited"] for r in long]) - 0.5) < 0.1
    assert np.median([r["near_next"] for r in long]) < 0.05


def test_languages(spark, docs):
    got = rows(spark, "op2_language_id")
    assert len(got) == len(docs)
    right = [got[d["doc_id"]]["language"] == d["lang"] for d in docs if len(d["text"]) > 100]
    assert np.mean(right) > 0.98


def test_pieces_round_trip(spark, docs):
    got = rows(spark, "op6_sentencepiece")
    assert len(got) == len(docs)
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got.values())


def plain_removal(docs):
    """(removed, spans, digest of the rest) of each document, all 50-byte strings compared."""
    first = {}
    for d in docs:
        raw = (d["text"] or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d["doc_id"])
    out = {}
    for d in docs:
        raw = (d["text"] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < d["doc_id"]:
                gone[i : i + 50] = b"\1" * 50
        rest = bytes(c for c, g in zip(raw, gone) if not g)
        out[d["doc_id"]] = (sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return out


def test_long_matches(spark, docs):
    got = rows(spark, "op3_suffix_dedup")
    want = plain_removal(docs)
    assert len(got) == len(docs) and any(w[0] for w in want.values())
    for d in docs:
        r = got[d["doc_id"]]
        assert r["n_bytes"] == len(d["text"].encode())
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[d["doc_id"]]
