"""SentencePiece encoding and decoding with Viterbi scores shared between words.

A text is marked (blanks become a visible mark, one is put in front) and cut into words
where no piece can reach across. The distinct words of a batch are sorted, which is a
depth-first walk of their trie: a word keeps the forward scores of the prefix it shares
with the word before it and goes on from there. Characters without a piece fall back to
their bytes.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import release, slices

MARK = "▁"
#: Where the public vocabulary lies on this machine; a parameter of every function.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of one worker that are remembered between batches; then it starts anew.
REMEMBERED = 400_000
#: Below the lowest piece score by this much: the score of a character that needs its bytes.
UNKNOWN_PENALTY = 10.0


def pack_ids(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def unpack_ids(packed: bytes) -> list[int]:
    return array("i", packed).tolist()


class Pieces:
    """The vocabulary of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.scores: dict[str, tuple[float, int]] = {}
        self.raw: list[bytes] = [b""] * len(ids)
        byte_of = {i: b for b, i in enumerate(self.bytes)}
        for i in ids:
            if i in byte_of:
                self.raw[i] = bytes([byte_of[i]])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self.scores[piece] = (model.get_score(i), i)
                self.raw[i] = piece.replace(MARK, " ").encode()
        # Trie of the pieces: characters to (branches, score or None, id).
        self.trie: dict = {}
        for piece in sorted(self.scores, key=len):
            node = self.trie
            for c in piece[:-1]:
                node = node.setdefault(c, ({}, None, -1))[0]
            below = node.get(piece[-1], ({},))[0]
            node[piece[-1]] = (below, *self.scores[piece])
        self.unknown = min(s for s, _ in self.scores.values()) - UNKNOWN_PENALTY
        # Characters inside longer pieces; all others always stand alone.
        inside = {c for p in self.scores if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece goes on over a word mark")
        joined = "".join(sorted(re.escape(c) for c in inside - {MARK}))
        self.cut = re.compile(f"{MARK}*[{joined}]+|{MARK}+|[^{joined}{MARK}]")

    def words(self, text: str) -> list[str]:
        """The marked words of a text; no piece reaches over the end of one."""
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words as packed 32-bit numbers, found in one depth-first walk over their trie.

        On the stack lie, for every character of the current word, the best score up to it,
        the piece that ends there, and the pieces that are still open: those whose trie
        goes on. A word starts from the stack of the prefix it shares with the word before.
        """
        out = {}
        stack: list[tuple] = [(0.0, 0, -1, ())]  # best score, start and number of the last piece, open pieces
        trie, scores, unknown = self.trie, self.scores, self.unknown
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del stack[shared + 1 :]
            best, _, _, open_ = stack[-1]
            for end in range(shared, len(word)):
                c = word[end]
                top, at, piece, alive = -1e300, end, -1, []
                for branches, base, start in open_:
                    if c in branches:
                        below, score, number = branches[c]
                        if score is not None and base + score > top:
                            top, at, piece = base + score, start, number
                        if below:
                            alive.append((below, base, start))
                if c in trie:
                    below, score, number = trie[c]
                    if score is not None and best + score > top:
                        top, at, piece = best + score, end, number
                    if below:
                        alive.append((below, best, end))
                if best + unknown > top and c not in scores:
                    top, at, piece = best + unknown, end, -1
                best, open_ = top, alive
                stack.append((top, at, piece, alive))
            ids = []
            end = len(word)
            while end:
                _, start, piece, _ = stack[end]
                if piece >= 0:
                    ids.append(piece)
                else:
                    text = word[start:end].replace(MARK, " ").encode("utf-8", "surrogatepass")
                    ids += [self.bytes[b] for b in reversed(text)]
                end = start
            ids.reverse()
            out[word] = pack_ids(ids)
            before = word
        return out

    def decode(self, ids) -> str:
        """The text of the ids; the blank put in front goes. Bytes that are no UTF-8 become U+FFFD."""
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@cache
def pieces(path: str) -> Pieces:
    """The model, read once in each worker: a shared file, or one sent with addFile."""
    return Pieces(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def encoded(text: Column, model: str = MODEL) -> Column:
    """The ids of each text as array<int>; empty for a null or empty text."""

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary, known = pieces(model), {}
        for texts in batches:
            parts = [_lists(vocabulary, part, known) for part in slices(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
        release()

    return encode(text)


def _lists(vocabulary: Pieces, texts: pa.Array, known: dict[str, bytes]) -> pa.ListArray:
    """The ids of each text. `known` keeps words between calls, up to REMEMBERED of them."""
    cut = [vocabulary.words(t or "") for t in texts.to_pylist()]
    if len(known) > REMEMBERED:
        known.clear()
    known.update(vocabulary.encode_words([w for w in set(chain.from_iterable(cut)) if w not in known]))
    flat = [b"".join(map(known.__getitem__, words)) for words in cut]
    ends = np.cumsum([0, *map(len, flat)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(flat), np.int32)))


def decoded(ids: Column, model: str = MODEL) -> Column:
    """The text of each array of ids; null for null. Exact inverse of `encoded`."""

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = pieces(model)
        for rows in batches:
            yield pa.array([None if r is None else vocabulary.decode(r) for r in rows.to_pylist()], pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, *, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns, ids, n_pieces and round_trip: one row per input row.

    The ids maximise the sum of the model's piece scores. round_trip tells whether
    decoding the ids gives the text back, byte for byte; it fails only for a text that holds
    the word mark itself, which decodes to a blank. Null texts count as empty and have no ids.
    Repeated rows are encoded each for itself; an empty table gives no rows.
    """
    kept = docs.select(*keep, F.coalesce(docs["text"], F.lit("")).alias("ids")).schema.fields
    schema = T.StructType([
        *kept[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("n_pieces", T.LongType()), T.StructField("round_trip", T.BooleanType()),
    ])
    names = schema.names

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = pieces(model), {}
        for batch in batches:
            texts, at = batch.column(batch.num_columns - 1), 0
            for part in slices(texts):
                lists = _lists(vocabulary, part, known)
                sizes = pc.list_value_length(lists).cast(pa.int64())
                same = [vocabulary.decode(ids.tolist()) == t for ids, t in zip(_rows(lists), part.to_pylist())]
                own = batch.slice(at, len(part)).columns[:-1]
                at += len(part)
                yield pa.RecordBatch.from_arrays([*own, lists, sizes, pa.array(same, pa.bool_())], names)
        known.clear()
        release()

    return docs.select(*keep, F.coalesce(docs["text"], F.lit("")).alias("text")).mapInArrow(encode, schema)


def _rows(lists: pa.ListArray) -> Iterator[np.ndarray]:
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield flat[a:b]
