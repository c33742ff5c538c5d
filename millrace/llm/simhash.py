"""SimHash near-duplicates by a self-join over a binary trie.

Fingerprints are compared as paths of a binary trie: pairs of nodes are walked together,
the differing bits on the way are summed, and a pair is dropped as soon as the sum
exceeds the error budget. Of 64 bits in four quarters at least one quarter differs in at
most a quarter of the budget, so the trie is walked from each quarter in turn with that
smaller budget on its top levels. The node pairs after the top levels are dealt out to
the tasks; the rest of the walk is local.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import release, slices
from millrace.llm.common import packed, unpacked
from millrace.llm.graph import components, local_roots
from millrace.operators.lineage import materialize

BITS = 64
#: Walks of the trie, each starting at another quarter of the fingerprint.
TURNS = 4
#: Bits of the top levels, whose node pairs are dealt out.
TOP = BITS // TURNS
#: Pairs of leaves that are compared at once.
LEAF_PAIRS = 1 << 18

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of a text's word shingles, as a signed 64-bit number."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(found) > width:
        spans = zip(starts[: 1 - width].tolist() if width > 1 else starts.tolist(), ends[width - 1 :].tolist())
        n = len(found) - width + 1
    else:
        spans, n = [(0, len(joined))], 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    octets = hashes.view(np.uint8).reshape(n, 8)
    out = 0
    for k in range(8):
        ones = np.bincount(octets[:, k], minlength=256) @ _BIT
        for b in np.flatnonzero(2 * ones > n):
            out |= 1 << (8 * k + int(b))
    return out - (1 << 64) if out >> 63 else out


def fingerprints(text: Column, width: int) -> Column:
    @F.arrow_udf(T.LongType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t, width) for part in slices(texts) for t in part.to_pylist()], pa.int64())
        release()

    return of(text)


def spelled(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _walk(a: np.ndarray, pairs: list, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked leaves below the given node pairs of the sorted leaves `a`.

    pairs: (low, high, low, high, bits walked, bits that differ so far). Small pairs are
    gathered and compared in whole arrays; large ones are split at the next bit.
    """
    small: list = []
    waiting = 0
    todo = list(pairs)
    while todo or small:
        if todo:
            lo, hi, lo2, hi2, depth, err = todo.pop()
            size = (hi - lo) * (hi2 - lo2)
            if size and (size <= LEAF_PAIRS or depth == BITS):
                small.append((lo, hi, lo2, hi2))
                waiting += size
            elif size:
                bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
                mid, mid2 = _split(a, lo, hi, bit), _split(a, lo2, hi2, bit)
                todo += [(lo, mid, lo2, mid2, depth + 1, err), (mid, hi, mid2, hi2, depth + 1, err)]
                if err < budget:
                    todo.append((lo, mid, mid2, hi2, depth + 1, err + 1))
                    if (lo, hi) != (lo2, hi2):
                        todo.append((mid, hi, lo2, mid2, depth + 1, err + 1))
        if small and (waiting >= LEAF_PAIRS or not todo):
            left, right = _expanded(np.array(small, dtype=np.int64))
            near = np.bitwise_count(a[left] ^ a[right]) <= budget
            yield left[near], right[near]
            small, waiting = [], 0


def _split(a: np.ndarray, lo: int, hi: int, bit: np.uint64) -> int:
    """First leaf of the node [lo, hi) that has the bit."""
    if lo == hi:
        return lo
    first = (a[lo] & ~(bit | (bit - np.uint64(1)))) | bit
    return lo + int(np.searchsorted(a[lo:hi], first))


def _expanded(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi, lo2, hi2 = spans.T
    wide = hi2 - lo2
    sizes = (hi - lo) * wide
    which = np.repeat(np.arange(len(spans)), sizes)
    at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = lo[which] + at // wide[which], lo2[which] + at % wide[which]
    keep = (left < right) | (lo[which] != lo2[which])
    return left[keep], right[keep]


def _linker(budget: int):
    """Node pairs of one task to links between fingerprints; a spanning forest of them."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        node = table["node"].to_numpy()
        leaf = table["leaf"].to_numpy().view(np.uint64)
        home = table["home"].to_numpy()
        order = np.lexsort((leaf, ~home, node))
        node, leaf, home = node[order], leaf[order], home[order]
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        ends = np.r_[starts[1:], len(node)]
        homes = np.add.reduceat(home.astype(np.int64), starts)
        pairs = []
        for lo, hi, n in zip(starts.tolist(), ends.tolist(), homes.tolist()):
            if n:
                pairs.append((lo, lo + n, lo, lo + n, TOP, 0))
                # Visitors differ in one top bit, in as many groups as there are such bits.
                if lo + n < hi:
                    pairs.append((lo, lo + n, lo + n, hi, TOP, 1))
        values, slot = np.unique(_unturned(leaf, node), return_inverse=True)
        roots = np.arange(len(values))
        for left, right in _walk_groups(leaf, pairs, budget):
            roots = local_roots(roots, slot[left], slot[right])
        linked = np.flatnonzero(roots != np.arange(len(values)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[linked].view(np.int64)), pa.array(values[roots[linked]].view(np.int64))], ["a", "b"]
        )

    return link


def _walk_groups(leaf: np.ndarray, pairs: list, budget: int):
    """As `_walk`; visitors are sorted below their top bits only within their own top node."""
    split: list = []
    for lo, hi, lo2, hi2, depth, err in pairs:
        if lo == lo2 or (hi - lo) * (hi2 - lo2) <= LEAF_PAIRS:
            split.append((lo, hi, lo2, hi2, depth, err))
            continue
        top = leaf[lo2:hi2] >> np.uint64(BITS - TOP)
        cuts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), hi2 - lo2]):
            split.append((lo, hi, lo2 + a, lo2 + b, depth, err))
    return _walk(leaf, split, budget)


def _unturned(leaf: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The fingerprint behind a turned leaf; the turn is above the top bits in `node`."""
    by = ((node >> TOP).astype(np.uint64) * np.uint64(TOP)) % np.uint64(BITS)
    back = (np.uint64(BITS) - by) % np.uint64(BITS)
    high = np.where(back == 0, np.uint64(0), leaf >> ((np.uint64(BITS) - back) % np.uint64(BITS)))
    return (leaf << back) | high


def _node_pairs(classes: DataFrame, budget: int) -> DataFrame:
    """node, leaf, home: each fingerprint at its node and at the nodes it must be compared with.

    The node is the quarter's number and its 16 bits; each unordered pair of nodes that
    differ in at most budget // TURNS bits meets at the larger node.
    """
    fp = F.col("fp")
    each = classes.select(fp, F.explode(F.array(*[F.lit(t) for t in range(TURNS)])).alias("turn"))
    wrapped = f"case when turn = 0 then 0 else shiftrightunsigned(fp, {BITS} - turn * {TOP}) end"
    turned = F.expr(f"shiftleft(fp, turn * {TOP}) | {wrapped}")
    leaf = each.select("turn", turned.alias("leaf"))
    own = F.shiftrightunsigned("leaf", BITS - TOP)
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(budget // TURNS)])
    here = leaf.select("turn", "leaf", own.alias("own"), F.explode(masks).alias("mask"))
    other = F.col("own").bitwiseXOR(F.col("mask"))
    return here.filter(other >= F.col("own")).select(
        (F.col("turn") * (1 << TOP) + other).cast("long").alias("node"), "leaf", (F.col("mask") == 0).alias("home")
    )


def _masks(most: int) -> Iterator[int]:
    for k in range(most + 1):
        for bits in combinations(range(TOP), k):
            yield sum(1 << b for b in bits)


def links(classes: DataFrame, budget: int) -> DataFrame:
    """a, b: links between distinct fingerprints that span all classes of linked ones.

    A task emits a spanning forest of the links it finds, never all pairs of a group.
    """
    dealt = _node_pairs(classes, budget).repartition("node")
    return dealt.mapInArrow(_linker(budget), "a long, b long")


def grouped(docs: DataFrame, *, width: int = 4, budget: int = 4) -> DataFrame:
    """doc_id, mark, fp, component_id, root: one row per document.

    fp is the fingerprint of the `width`-word shingles (a shorter text is one shingle, a
    text without a word or a null text has 0); documents whose fingerprints differ in at most
    `budget` bits are linked, equal fingerprints always. component_id is the smallest
    doc_id that links lead to, null only if no document there has an id. mark is a hash
    of the text, root one fingerprint of the component. Repeated rows each get a row.
    """
    marked = materialize(
        docs.select("doc_id", F.xxhash64("text").alias("mark"), fingerprints(F.col("text"), width).alias("fp"))
    )
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes, budget))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "root")
    return marked.join(known, "fp").select("doc_id", "mark", "fp", "component_id", "root")


def representatives(docs: DataFrame, *, width: int = 4, budget: int = 4) -> DataFrame:
    """The rows of `docs`, one of each component: the one with the smallest id.

    Null ids come after all others; equal ids are decided by a hash of the text, and of
    repeated rows one stays.
    """
    groups = grouped(docs, width=width, budget=budget)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    keep = (
        groups.groupBy("root")
        .agg(first)
        .select(F.col("first.doc_id").alias("keep_id"), F.col("first.mark").alias("keep_mark"))
        .distinct()
    )
    rows = packed(docs, keep_mark=F.xxhash64(docs["text"]), keep_id=docs["doc_id"])
    match = (rows["keep_mark"] == keep["keep_mark"]) & rows["keep_id"].eqNullSafe(keep["keep_id"])
    some = rows.join(keep, match, "left_semi")
    once = some.groupBy("keep_mark", "keep_id").agg(F.first("row").alias("row"))
    return unpacked(once, docs.columns)
