"""Alignment of two tokenizers beside a plain program that walks all token pairs."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.hot_keys import join_counted
from millrace.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """The two libraries themselves, their tokens' bytes, and the definition word for word."""

    def __init__(self):
        self.a = Tokenizer.from_file(alignment.BYTE_MODEL)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=alignment.MODEL)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    def a_bytes(self, i):
        return bytes(self.letters[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, text):
        """(id, first byte, end) of the tokens of both; two empty lists without tokens."""
        out = []
        for ids, raw in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes), (self.b.encode(text), self.b_bytes)):
            tokens, at = [], 0
            for i in ids:
                tokens.append((i, at, at + len(raw(i))))
                at = tokens[-1][2]
            if not text or b"".join(raw(i) for i in ids) != (" " + text).encode():
                return [], []
            out.append(tokens)
        return out

    def links(self, a, b):
        out, j = [], 0
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                out.append((i, b[k][0]))
                k += 1
        return out

    def groups(self, a, b):
        cuts = sorted({t[2] for t in a} & {t[2] for t in b})
        inside = lambda tokens, lo, hi: ",".join(str(t[0]) for t in tokens if lo < t[2] <= hi)
        return [f"{inside(a, lo, hi)}|{inside(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts)]

    def measures(self, texts):
        spans = [self.spans(t or "") for t in texts]
        links = [self.links(*s) for s in spans]
        counts = Counter(p for found in links for p in set(found))
        highest = {}
        for (a, _), n in counts.items():
            highest[a] = max(highest.get(a, 0), n)
        out = []
        for (a, b), found in zip(spans, links):
            groups = self.groups(a, b)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
            best = sum(counts[p] == highest[p[0]] for p in found)
            out.append((len(a), len(b), len(groups), len(found), best, sum(counts[p] for p in found), digest))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.byte_tokens(alignment.BYTE_MODEL), alignment.piece_tokens(alignment.MODEL))


def test_query_on_whole_table(spark, plain):
    rows = pq.read_table(f"{ROOT}/documents.parquet").to_pylist()
    got = {r["doc_id"]: tuple(r[m] for m in MEASURES) for r in QUERIES["op13_tokenizer_alignment"](spark, ROOT).toArrow().to_pylist()}
    assert got == dict(zip([r["doc_id"] for r in rows], plain.measures([r["text"] for r in rows])))


ODD = [
    (1, None), (2, ""), (3, " "), (None, "same text"), (None, "same text"), (4, "same text"), (4, "other <|endoftext|> <s> text"),
    (5, "holds the mark ▁ itself"), (6, "\x00\x01\t\n\r  \x7f é 漢字 \U0001f600 ͸ ꙮ Straßenbahn"), (7, "  leading and trailing  "),
    (8, "internationalization 1234567 isn't " * 2000),
]


def test_odd_rows(spark, plain):
    docs = spark.createDataFrame([(*r, "p", 1, 2) for r in ODD], "doc_id long, text string, digest string, copies int, place int")
    got = alignment.align_documents(docs).collect()
    want = plain.measures([t for _, t in ODD])
    assert sorted((str(r["doc_id"]), *[r[m] for m in MEASURES]) for r in got) == sorted((str(i), *m) for (i, _), m in zip(ODD, want))
    assert want[7][0] == 0 and want[7][-1] == "" and want[6][0] > 0 and want[8][0] > 0
    assert alignment.align_documents(docs.limit(0)).collect() == []


def test_copies_count_each(spark, plain):
    texts = ["one shared text of many documents"] * 400 + [f"rare text {i % 90} with shared words" for i in range(300)] + [None] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: tuple(r[m] for m in MEASURES) for r in alignment.align_documents(docs).collect()}
    assert got == dict(enumerate(plain.measures(texts)))


def test_heavy_and_light_keys_meet(spark):
    facts = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 3 = 1 then 100 + id % 50 else null end as k")
    table = facts.filter("k is not null").groupBy("k").count().withColumn("v", (facts.k * 2).cast("long"))
    for most in (1, 2, 10, 1000):
        got = join_counted(facts, table, "k", "count", 2000, most).collect()
        assert len(got) == 2000 and all(r["v"] == 2 * r["k"] for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60), min_size=1, max_size=6))
def test_tokens_are_those_of_the_libraries(plain, aligner, texts):
    a, b = aligner.tokens(texts)
    for k, text in enumerate(texts):
        want = plain.spans(text)
        assert [[t[0] for t in side] for side in want] == [a[k].tolist(), b[k].tolist()]


def test_settled_letters_cut_alike(aligner):
    tokens = aligner.sides[0]
    for c in map(chr, [*range(0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x2300), *range(0x4E00, 0x9FA6, 50)]):
        text = f" a{c}a {c}1{c} {c} {c}{c}  {c}a\n{c}"
        assert alignment.SETTLED.fullmatch(text)
        assert tokens.quick.encode_ordinary(text) == tokens.library.encode(text, add_special_tokens=False).ids
