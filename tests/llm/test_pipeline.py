"""Each stage of the pipeline beside a plain program on what the stage before it kept."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from millrace.llm import language_id, pieces
from millrace.llm.queries_text import OP5_SQL
from tests.llm.test_brute_force import plain_components, plain_fingerprint

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage returns, by name, written and read again as on a cluster."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    out = {"input": docs.toArrow()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, ROOT).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.toArrow()
    return out


def by_id(table: pa.Table) -> dict:
    return {r["doc_id"]: r for r in table.to_pylist()}


def plain_languages(rows: list[dict]) -> dict:
    """doc_id to (language, posterior), by sums over dictionaries; (None, 0) without a letter."""
    grams = {}
    for r in rows:
        raw = language_id._letters(r["text"])
        codes = [int.from_bytes(raw[i : i + 3], "big") for i in range(len(raw) - 2)]
        grams[r["doc_id"]] = [(c * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for c in codes]
    languages = sorted({r["lang"] for r in rows if r["lang"]})
    table = {l: Counter() for l in languages}
    for r in rows:
        if r["lang"]:
            table[r["lang"]].update(grams[r["doc_id"]])
    totals = {l: sum(t.values()) + 0.5 * language_id.CELLS for l, t in table.items()}
    flat = [(sum((table[l][g] + 0.5) / totals[l] for l in languages) / len(languages)) ** 0.5 for g in range(language_id.CELLS)]
    rest = [math.log(0.7 * f / math.fsum(flat) + 0.3 / language_id.CELLS) for f in flat]

    def text(doc):
        own = grams[doc]
        sums = {l: sum(math.log((table[l][g] + 0.5) / totals[l]) for g in own) for l in languages}
        sums[None] = sum(rest[g] for g in own)
        return {l: s / max(len(own), 1) * min(len(own), language_id.EVIDENCE) for l, s in sums.items()}

    scores = {r["doc_id"]: text(r["doc_id"]) for r in rows}
    letters = {r["doc_id"] for r in rows if any(c.isalpha() for c in r["text"])}
    wins = {d: max(languages, key=lambda l: s[l]) for d, s in scores.items()}
    wins = {d: l for d, l in wins.items() if d in letters and scores[d][l] >= scores[d][None]}
    hosts, declared, whole = defaultdict(Counter), defaultdict(Counter), Counter(wins.values())
    for r in rows:
        if r["doc_id"] in wins:
            hosts[r["source"]][wins[r["doc_id"]]] += 1
            declared[r["lang"]][wins[r["doc_id"]]] += 1
    declared.pop(None, None)
    weight, n = language_id.PRIOR_WEIGHT, len(wins)
    carrying = Counter()
    for counts in declared.values():
        carrying.update(counts)
    out = {}
    for r in rows:
        post = {}
        given = {l: (declared[r["lang"]][l] + 1) / (carrying[l] + len(declared) + 1) if r["lang"] in declared else 1 for l in languages}
        for l in languages:
            corpus = (whole[l] + 1) / (n + len(languages))
            host = hosts[r["source"]]
            prior = (host[l] + weight * corpus) / (sum(host.values()) + weight)
            if r["source"] not in hosts:
                prior = 1 / len(languages)
            post[l] = scores[r["doc_id"]][l] + math.log(prior) + math.log(given[l])
        post[None] = scores[r["doc_id"]][None] + math.log(0.001) + math.log(sum(given.values()) / len(languages))
        best, top = max(languages, key=lambda l: post[l]), max(post.values())
        share = math.exp(post[best] - top) / sum(math.exp(p - top) for p in post.values())
        out[r["doc_id"]] = (best, share) if r["doc_id"] in letters else (None, 0)
    return out


def test_language_stage(kept):
    want = plain_languages(kept["input"].to_pylist())
    got = by_id(kept["language_id"])
    assert set(got) == {d for d, (l, share) in want.items() if l and share >= 0.5}
    assert all(r["lang"] == want[d][0] for d, r in got.items())


#: Words of a language that no document of the tables has.
WELSH = """roedd y bore yn braf ac aeth plant i ysgol gyda llyfrau newydd mae tywydd oer heddiw ond bydd hi gynnes yfory ôl
rhagolygon prynodd fy mam fara llaeth a chaws siop ar gornel stryd hen wlad nhadau annwyl mi gwlad beirdd chantorion""".split()


def test_noise_and_unknown_languages_go(spark, kept):
    rng = random.Random(5)
    rows = kept["input"].to_pylist()
    hosts = [r["source"] for r in rows]
    noise = [" ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randrange(3, 9))) for _ in range(60)) for _ in range(20)]
    noise += ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(120)) for _ in range(20)]
    noise += [" ".join(rng.choices(WELSH, k=50)) for _ in range(20)]
    strange = [{**rows[0], "doc_id": 10_000 + i, "text": t, "lang": None, "source": rng.choice(hosts)} for i, t in enumerate(noise)]
    both = rows + strange
    docs = spark.createDataFrame(pa.Table.from_pylist(both, kept["input"].schema))
    found = language_id.identify(language_id.document_evidence(docs, ["doc_id"])).collect()
    got = {r["row"]["doc_id"]: r for r in found}
    want = plain_languages(both)
    for d, (language, share) in want.items():
        assert got[d]["language"] == language and got[d]["posterior"] == pytest.approx(share, abs=1e-3)
        assert got[d]["accepted"] == (language is not None and share >= 0.5)
    assert not any(got[r["doc_id"]]["accepted"] for r in strange)
    clean = [r for r in rows if r["lang"] and len(r["text"]) > 100]
    assert sum(not got[r["doc_id"]]["accepted"] for r in clean) <= 0.01 * len(clean)


def test_line_stage(kept):
    rows = kept["language_id"].to_pylist()
    places = defaultdict(list)
    for r in rows:
        for i, line in enumerate((r["text"]).split("\n")):
            if body := line.strip(" \t\n\r\x0b\x0c"):
                places[body].append((r["doc_id"], i, r["source"]))
    gone = set()
    for where in places.values():
        if len({s for *_, s in where}) >= 4:
            gone |= {(d, i) for d, i, _ in where} - {min((d, i) for d, i, _ in where)}
    got = by_id(kept["line_dedup"])
    assert len(got) == len(rows) and gone
    for r in rows:
        lines = r["text"].split("\n")
        clean = "\n".join(x for i, x in enumerate(lines) if (r["doc_id"], i) not in gone)
        assert got[r["doc_id"]]["text"] == clean
        assert got[r["doc_id"]]["n_chars"] == (len(clean) if clean != r["text"] else r["n_chars"])


def test_near_duplicate_stage(kept):
    rows = sorted(kept["line_dedup"].to_pylist(), key=lambda r: r["doc_id"])
    roots = plain_components([plain_fingerprint(r["text"]) for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    want = {rows[i]["doc_id"] for i in set(roots)}
    assert set(by_id(kept["simhash_near_dedup"])) == want
    assert kept["simhash_near_dedup"].num_rows == len(want) < len(rows)


def test_mix_stage(kept):
    con = duckdb.connect()
    con.register("documents", kept["simhash_near_dedup"])
    times = {d: taken // size for d, size, taken in con.sql(f"select doc_id, size, taken from ({OP5_SQL}) where taken > 0").fetchall()}
    assert Counter(kept["source_mix"]["doc_id"].to_pylist()) == times


def test_encoding_stage(kept):
    vocabulary = pieces.pieces(pieces.MODEL)
    texts = by_id(kept["source_mix"])
    rows = kept["sentencepiece"].to_pylist()
    assert len(rows) == kept["source_mix"].num_rows
    for r in rows:
        assert vocabulary.decode(r["ids"]) == texts[r["doc_id"]]["text"] and r["round_trip"]


def test_run_gives_the_last_stage(spark, kept):
    got = corpus_pipeline.run(spark, ROOT).toArrow()
    key = lambda t: sorted((r["doc_id"], tuple(r["ids"])) for r in t.to_pylist())
    assert key(got) == key(kept["sentencepiece"])
