"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On each level runs of one symbol become one symbol, labels
from deterministic coin tossing mark local maxima, and the symbols from one maximum to the
next form a phrase; its name is a hash of the names in it and a symbol of the next level.
A phrase depends on a few symbols around it only, so equal substrings get the same
phrases inside, wherever they stand. A fingerprint holds the smallest hashes of a text's
phrase names, and the likeness of two fingerprints estimates the Jaccard index of the names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names on this level and above are signatures; phrases there hold about ten bytes or more.
LEVEL = 2
#: Signatures that a fingerprint keeps: the smallest ones.
KEPT = 64
#: Bytes a worker parses in one array.
CHUNK = 1 << 20
#: Ranges of ids per shuffle partition.
RANGES = 8

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels under 6 of symbols that differ from their left neighbour; `first` marks text starts.

    A label becomes twice the place of the lowest bit in which it differs from its left
    neighbour, plus that bit, until the number of labels no longer falls.
    """
    x = names
    for _ in range(3 if names.dtype == np.uint8 else 4):
        left = np.empty_like(x)
        left[1:] = x[:-1]
        left[first] = ~x[first]
        differ = x ^ left
        low = np.bitwise_count((differ & (~differ + x.dtype.type(1))) - x.dtype.type(1)).astype(x.dtype)
        low[differ == 0] = 0  # only next to a text's start
        x = (low * 2 + ((x >> low) & x.dtype.type(1))).astype(np.uint8)
    return x


def _phrases(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of texts that begin at `starts`, and where the texts begin among them.

    A text of one symbol is left as it is; any longer one gets shorter.
    """
    n = len(names)
    first = np.zeros(n, bool)
    first[starts] = True
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    wide = names.astype(np.uint64)
    if not new.all():  # runs become one symbol
        heads = np.flatnonzero(new)
        lengths = np.diff(np.r_[heads, n]).astype(np.uint64)
        names, wide, first = names[heads], wide[heads], first[heads]
        run = lengths > 1
        wide[run] = _mix(wide[run] + lengths[run] * _ODD)
        n = len(names)
        starts = np.flatnonzero(first)
    labels = _labels(names, starts)
    cut = first.copy()
    cut[1:-1] |= (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:]) & ~first[2:]
    heads = np.flatnonzero(cut)
    lengths = np.diff(np.r_[heads, n])
    inside = np.arange(n) - np.repeat(heads, lengths)
    weights = _mix(np.arange(1, int(lengths.max()) + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    sums = np.add.reduceat(_mix(wide + _ODD) * weights[inside], heads)
    single = np.diff(np.r_[starts, n]) == 1
    out = _mix(sums + lengths.astype(np.uint64))
    at = np.searchsorted(heads, starts)
    out[at[single]] = wide[starts[single]]
    return out, at


def signatures(texts: list[bytes]) -> list[np.ndarray]:
    """Per text the KEPT smallest 32-bit hashes of its phrase names, ascending.

    A text that shrinks to one symbol below LEVEL is its own only phrase.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    full = np.flatnonzero(sizes)
    out = [np.zeros(0, np.uint32)] * len(texts)
    if not len(full):
        return out
    names = np.frombuffer(b"".join(texts), np.uint8)
    starts = (np.cumsum(sizes) - sizes)[full]
    level, found = 0, []
    while True:
        counts = np.diff(np.r_[starts, len(names)])
        last = counts == 1
        owner = np.repeat(np.arange(len(full)), counts)
        take = last[owner] if level < LEVEL else np.ones(len(owner), bool)
        hashes = _mix(names[take].astype(np.uint64) + np.uint64(level < LEVEL)) >> np.uint64(32)
        found.append((full[owner[take]].astype(np.uint64) << np.uint64(32)) | hashes)
        go = ~last
        if not go.any():
            break
        keep = go[owner]
        names, full = names[keep], full[go]
        starts = np.cumsum(counts[go]) - counts[go]
        names, starts = _phrases(names, starts)
        level += 1
    every = np.sort(np.concatenate(found))
    every = every[np.r_[True, every[1:] != every[:-1]]]
    text = (every >> np.uint64(32)).astype(np.int64)
    low = (every & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(text)]):
        out[text[a]] = low[a : min(b, a + KEPT)]
    return out


def spelled(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common names among the smallest of both; 1 for two empty texts."""
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate([a, b]))
    again = both[1:] == both[:-1]
    twice = both[1:][again]
    seen = both[np.r_[True, ~again]][:KEPT]
    return float(np.searchsorted(twice, seen[-1], "right")) / len(seen)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of another."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
    """Result rows of consecutive documents, given the text after the last."""
    after = [*texts[1:], following]
    new = [edited(t, f) for t, f in zip(texts, after)]
    raw = [t.encode("utf-8", "surrogatepass") for t in new]
    own = signatures([t.encode("utf-8", "surrogatepass") for t in [*texts, following]])
    of_new = signatures(raw)
    columns = [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
        pa.array([spelled(s) for s in own[:-1]]), pa.array([spelled(s) for s in of_new]),
        pa.array([likeness(a, b) for a, b in zip(own, of_new)]),
        pa.array([likeness(a, b) for a, b in zip(own, own[1:])]),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and place: each is compared with the one after it in its range.

    The last row of a range is a copy of the first one of the next (`edge`) and only followed.
    """
    ids: list = []
    texts: list[str] = []
    size, span, spare = 0, None, False
    for batch in batches:
        for pid, edge, doc_id, text in zip(*(c.to_pylist() for c in batch.columns[:4])):
            if pid != span:
                ids, texts, size, span, spare = [], [], 0, pid, False
            if spare:  # one follower is enough
                continue
            if texts and (edge or size >= CHUNK):
                yield _compare(ids, texts, text)
                ids, texts, size = [], [], 0
            if edge:
                spare = True
                continue
            ids.append(doc_id)
            texts.append(text)
            size += len(text)


def _ranges(docs: DataFrame):
    """Bounds of id ranges, ascending, and for each id that begins a range the range before it."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES
    named = docs.select("doc_id").filter("doc_id is not null")
    shares = [i / n for i in range(1, n)]
    bounds = named.agg(F.percentile_approx("doc_id", F.lit(shares), 50 * n)).first()[0] if shares else []
    bounds = np.unique(np.array(bounds or [], np.int64))
    of = F.pandas_udf(lambda ids: pd.Series(np.searchsorted(-bounds[::-1], -ids.to_numpy(np.int64), "right")), T.LongType())
    firsts = {r["pid"]: r["doc_id"] for r in named.groupBy(of("doc_id").alias("pid")).agg(F.max("doc_id").alias("doc_id")).collect()}
    unnamed = docs.filter("doc_id is null").agg(F.count(F.lit(1)), F.min(F.xxhash64(F.coalesce("text", F.lit(""))))).first()
    order = sorted(firsts)
    last = len(bounds) + 1
    pids = order + ([last] if unnamed[0] else [])
    before = dict(zip(pids, pids[-1:] + pids[:-1]))
    return bounds, {firsts[p]: before[p] for p in order}, last, before.get(last), unnamed[1]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness.

    Columns as in SCHEMA. The edited text has its last third replaced by the beginning
    of the next document, in descending order of doc_id; null ids come last, equal ids in the order
    of a hash of their texts; after the last document comes the first. A null text is empty, an
    empty text has an empty fingerprint. A single document follows itself.

    Ids are cut into ranges by quantiles. The one document that begins a range is also
    sent to the range before it, so every range is compared alone, in one sorted pass that
    holds about CHUNK bytes; texts move through one exchange.
    """
    bounds, edges, last, before_last, first_hash = _ranges(docs)

    @F.pandas_udf("pid long, edge long")
    def placed(ids: pd.Series) -> pd.DataFrame:
        known = ids.notna()
        pid = np.full(len(ids), last)
        pid[known] = np.searchsorted(-bounds[::-1], -ids[known].to_numpy(np.int64), "right")
        return pd.DataFrame({"pid": pid, "edge": [edges.get(i, -1) for i in ids]})

    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("mark"), placed("doc_id").alias("at"))
    own = F.struct(F.col("at.pid").alias("pid"), F.lit(False).alias("edge"))
    unnamed = F.col("doc_id").isNull() & (F.col("mark") == F.lit(first_hash)) if before_last is not None else F.lit(False)
    target = F.when(unnamed, F.lit(before_last)).otherwise(F.col("at.edge"))
    copy = F.struct(target.cast("long").alias("pid"), F.lit(True).alias("edge"))
    both = rows.select(
        "doc_id", "text", "mark", F.explode(F.when(target >= 0, F.array(own, copy)).otherwise(F.array(own))).alias("to")
    )
    dealt = both.select("to.pid", "to.edge", "doc_id", "text", "mark").repartition("pid")
    ordered = dealt.sortWithinPartitions("pid", "edge", F.desc_nulls_last("doc_id"), "mark", "text").drop("mark")
    return ordered.mapInArrow(_compare_sorted, SCHEMA)
