"""Alignment of two tokenizers over a corpus, each distinct text once.

Both token sequences of a text cover the same bytes. Where tokens of both end, a group ends;
tokens whose bytes overlap are linked. Documents meet by their full text, so a text is
tokenised and aligned once however often it occurs, and its links count as often.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import release, slices
from millrace.llm.hot_keys import join_counted
from millrace.llm.pieces import MARK, MODEL
from millrace.operators.lineage import materialize

#: Where the byte-level vocabulary lies on this machine; a parameter of every function.
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: How the byte-level vocabulary's kind cuts a text into words (a fixed value of the published format).
BYTE_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters on which every edition of Unicode agrees; texts with others go to the vocabulary's own library.
SETTLED = re.compile(r"[\x00-ԯ‐-‧‰-⁞₠-⋿一-龥]*")
#: Bytes of text that a worker aligns at a time.
BATCH_BYTES = 1 << 20
#: Broadcast at most so many pairs, and so many texts: those with more than this share of all.
HEAVY_PAIRS = 1 << 17
HEAVY_TEXTS = 1000


def _local(path: str) -> str:
    """A file every worker sees, or one sent with addFile."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


class ByteTokens:
    """A byte-level BPE vocabulary; a blank is put before each text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocabulary = content["model"]["vocab"]
        # The format writes each byte as a visible letter: itself if printable, else one from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        letter = {chr(b): b for b in plain}
        letter |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {bytes(letter[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.raw = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in ranks.items():
            self.raw[i] = token
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.quick = tiktoken.Encoding("bytes", pat_str=BYTE_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [
            self.quick.encode_to_numpy(t).astype(np.int64)
            if SETTLED.fullmatch(t)
            else np.array(self.library.encode(t, add_special_tokens=False).ids, np.int64)
            for t in (" " + t for t in texts)
        ]


class PieceTokens:
    """A SentencePiece vocabulary; its model puts a blank before each text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        self.raw = [b""] * model.get_piece_size()
        for i in range(len(self.raw)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.raw[i] = piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # An empty text has no tokens, although the model would put a blank before it.
        return [np.frombuffer(array("i", ids), np.int32).astype(np.int64) for ids in self.model.encode(texts, num_threads=1)]


@cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(_local(path))


@cache
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(_local(path))


class Aligner:
    """Aligns texts by two vocabularies, a and b. A pair of ids is one number: id of a * `base` + id of b."""

    def __init__(self, a, b):
        self.sides = (a, b)
        self.base = len(b.raw)
        self.sizes = [np.array([len(t) for t in side.raw], np.int64) for side in self.sides]
        most = max(len(side.raw) for side in self.sides)
        width = len(str(most - 1))
        self.widths = np.array([len(str(i)) for i in range(most)])
        #: Digits of every number, left-aligned, with room for a sign after them.
        self.digits = np.zeros((most, width + 1), np.uint8)
        for i in range(most):
            d = str(i).encode()
            self.digits[i, : len(d)] = np.frombuffer(d, np.uint8)

    def tokens(self, texts: list[str]) -> list[list[np.ndarray]]:
        """The ids of each text by a and by b; none where the tokens do not spell the blank and the text."""
        both = [side.encode(texts) for side in self.sides]
        none = np.empty(0, np.int64)
        for k, text in enumerate(texts):
            want = (" " + text).encode()
            if not text or any(b"".join(map(s.raw.__getitem__, ids[k].tolist())) != want for s, ids in zip(self.sides, both)):
                both[0][k] = both[1][k] = none
        return both

    def align(self, texts: list[str]) -> list[pa.Array]:
        """Columns n_a, n_b, n_groups, n_links, groups and pairs.

        `pairs` holds one number per distinct pair of ids linked in the text: the pair * 2^32 + its links.
        """
        n = len(texts)
        both = self.tokens(texts)
        # All texts one after the other: both sides cover the same bytes, and each text ends with a group.
        a, b = (np.concatenate([*ids, np.empty(0, np.int64)]) for ids in both)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in both)
        of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        closes_a, closes_b = _among(end_a, end_b), _among(end_b, end_a)
        # Every stretch between neighbouring ends of either side is the overlap of one linked pair.
        ends = np.sort(np.concatenate([end_a, end_b[~closes_b]]), kind="stable")
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        links = np.bincount(of_a[i], minlength=n)
        pair, times = np.unique((of_a[i] << 32) + a[i] * self.base + b[j], return_counts=True)
        per_text = np.bincount(pair >> 32, minlength=n)
        packed = ((pair & 0xFFFFFFFF) << 32) + times
        return [
            pa.array(n_a), pa.array(n_b), pa.array(np.bincount(of_a[closes_a], minlength=n)), pa.array(links),
            self._spelled(a, b, closes_a, closes_b, n_a, n_b),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_text)], pa.int32()), pa.array(packed)),
        ]

    def _spelled(self, a, b, closes_a, closes_b, n_a, n_b) -> pa.Array:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        groups = int(closes_a.sum())
        # In a group the tokens of a come first, then those of b.
        at_a = np.arange(len(a)) + np.r_[0, np.cumsum(np.bincount(group_b, minlength=groups))][group_a]
        at_b = np.arange(len(b)) + np.cumsum(np.bincount(group_a, minlength=groups))[group_b]
        ids = np.empty(len(a) + len(b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        ids[at_a], ids[at_b] = a, b
        sign[at_a] = np.where(closes_a, ord("|"), ord(","))
        sign[at_b] = np.where(closes_b, ord(";"), ord(","))
        total = np.cumsum(n_a + n_b)
        sign[total[n_a > 0] - 1] = 0  # nothing after a text's last token
        cells = self.digits[ids]
        cells[np.arange(len(ids)), self.widths[ids]] = sign
        upto = np.r_[0, np.cumsum(self.widths[ids] + (sign > 0))]
        flat = cells.ravel()
        ends = np.r_[0, upto[total]].astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(n_a), [None, pa.py_buffer(ends), pa.py_buffer(flat[flat > 0])]).cast(pa.string())


def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the rising numbers x are also in the rising numbers y."""
    return np.append(y, -1)[np.searchsorted(y, x)] == x


ALIGNED = [
    *[T.StructField(n, T.LongType(), False) for n in ("n_a", "n_b", "n_groups", "n_links")],
    T.StructField("groups", T.StringType(), False), T.StructField("pairs", T.ArrayType(T.LongType(), False), False),
]


def align_texts(texts: DataFrame, *, first: str = BYTE_MODEL, second: str = MODEL) -> DataFrame:
    """The columns of `texts` but `text`, and n_a, n_b, n_groups, n_links, groups, pairs of each text.

    One row per input row. A null or empty text, and one that either vocabulary cannot
    spell back with a blank before it, has no tokens: zeros, '' and no pairs. An empty table
    gives no rows. `text` is the last column of `texts`.
    """
    fields = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, *ALIGNED])
    names = schema.names

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_tokens(first), piece_tokens(second))
        for batch in batches:
            at = 0
            for part in slices(batch.column(batch.num_columns - 1), BATCH_BYTES):
                own = batch.slice(at, len(part)).columns[:-1]
                at += len(part)
                yield pa.RecordBatch.from_arrays([*own, *aligner.align([t or "" for t in part.to_pylist()])], names)
        release()

    return texts.select(*[f.name for f in fields], "text").mapInArrow(align, schema)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """digest, copies, text: every distinct text with the number of documents that hold it; null counts as empty.

    Copies are counted before the shuffle, so a text that a third of the documents share
    travels once per task. `digest` is the address of a text in narrow tables.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    counted = docs.select(text.alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(_digest(F.col("text")).alias("digest"), "copies", "text")


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """pair, count, best: in how many documents ids of the two vocabularies are linked, and whether no
    other partner of the first id has a greater count.

    `aligned` has columns copies and pairs; `base` is the size of the second vocabulary.
    """
    held = aligned.select("copies", F.explode("pairs").alias("link"))
    counts = materialize(
        held.groupBy(F.shiftright("link", 32).alias("pair")).agg(F.sum("copies").alias("count"))
        .withColumn("a", F.floor(F.col("pair") / base))
    )
    # One row per id of the first vocabulary: as many as the vocabulary has, whatever the corpus.
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, *, first: str = BYTE_MODEL, second: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document.

    n_best counts the links whose pair is the most frequent of its first id in the corpus,
    ties included; count_sum adds up the documents that hold each link's pair. Documents
    without tokens (see `align_texts`) have zeros and ''. Equal texts have equal measures,
    repeated rows have a row each, also with null ids; an empty table gives no rows. Other
    columns of `docs`, whatever their names, are not read.
    """
    aligned = align_texts(distinct_texts(docs), first=first, second=second)
    spelled = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = aligned.withColumn("groups_sha256", spelled).drop("groups")
    # Numbered before it is written, so that a stored row has one number whoever reads it.
    aligned = materialize(aligned.withColumn("place", F.monotonically_increasing_id()))

    counts = materialize(pair_counts(aligned, len(piece_tokens(second).raw)))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    links = aligned.select("place", F.explode("pairs").alias("link"))
    links = links.select("place", F.shiftright("link", 32).alias("pair"), F.col("link").bitwiseAND(0xFFFFFFFF).alias("times"))
    known = join_counted(links, counts, "pair", "count", total, HEAVY_PAIRS)
    sums = known.groupBy("place").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    measures = materialize(
        aligned.join(sums, "place", "left")
        .select("digest", "copies", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
    )

    held = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), _digest(F.coalesce(docs["text"], F.lit(""))).alias("digest"))
    held = materialize(held)
    copies = measures.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    joined = join_counted(held, measures, "digest", "copies", copies, HEAVY_TEXTS)
    return joined.select("row.*", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
