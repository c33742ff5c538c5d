"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes, so any language is covered and an n-gram of five bytes is an exact
integer. Its counts come from all trusted training documents and stay distributed: they
are sharded by the two bytes before the predicted one, and so are the distinct n-grams of
every block of documents; each shard answers with log-probabilities. Perplexity per byte, of
the whole text and of its worst window, is thresholded by quantiles, per language, of
trusted documents that were not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import pack, slices, unpack
from millrace.operators.lineage import materialize
from millrace.operators.sizing import broadcast_if_small

ORDER = 5
#: Stands before a text's first byte; no UTF-8 text holds it.
EDGE = 0xFF
#: Text bytes of one block of documents, about.
BLOCK_BYTES = 8 << 20
#: Bytes of the windows of which a text's worst one counts, as a few words do not move the mean of a long text.
WINDOW = 8
#: Documents of a language above this quantile of its held-out trusted ones are rejected.
QUANTILE = 0.995
#: Parts of the documents; each is scored by a model that has learnt from the other.
FOLDS = 2
#: Trusted documents that the common distance between quantile and median counts for beside a language's own quantile.
COMMON_WEIGHT = 200
#: Trusted documents that the median over all languages counts for beside a language's own.
MEDIAN_WEIGHT = 5
#: Digits to which bits per byte are rounded before quantiles, which bounds their buffers.
DIGITS = 3
#: What is thresholded: bits per byte of the whole text and of its worst window.
MEASURES = ("bits", "worst")


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 5-grams that end at each byte, as integers, and the bounds of the texts among them."""
    pad = bytes([EDGE]) * (ORDER - 1)
    joined = pad + pad.join(texts)
    b = np.frombuffer(joined, np.uint8).astype(np.int64)
    n = len(b) - ORDER + 1
    grams = np.zeros(max(n, 0), np.int64)
    for k in range(ORDER):
        grams = (grams << 8) | b[k : k + n]
    keep = np.ones(max(n, 0), bool)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + ORDER - 1) - (ORDER - 1)
    for e in range(ORDER - 1):  # the paddings between texts are not predicted
        at = ends[:-1] + e
        keep[at[at < n]] = False
    return grams[keep], np.r_[0, np.cumsum(sizes)]


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed UTF-8 after their length, as they cross the network once and are read three times."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        small = [
            len(t).to_bytes(4, "little") + pa.compress(t, codec="zstd", asbytes=True)
            for some in slices(batch.column(at))
            for t in some.cast(pa.binary()).to_pylist()
        ]
        yield batch.set_column(at, "text", pa.array(small, pa.binary()))


def _runs(table: pa.Table, chars: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """The squeezed texts of a block in runs of about so many characters, with the place of the first."""
    start, part, size = 0, [], 0
    for i, t in enumerate(table["text"].to_pylist()):
        part.append(pa.decompress(t[4:], int.from_bytes(t[:4], "little"), codec="zstd", asbytes=True))
        size += len(part[-1])
        if size >= chars:
            yield start, part
            start, part, size = i + 1, [], 0
    if part:
        yield start, part


def _distinct(table: pa.Table) -> np.ndarray:
    found = [pd.unique(_grams(part)[0]) for _, part in _runs(table)]
    return np.sort(pd.unique(np.concatenate(found))) if found else np.zeros(0, np.int64)


def _shard(grams: np.ndarray, shards: int) -> np.ndarray:
    return _scatter((grams >> 8) & 0xFFFF) % shards


def _scatter(x):
    return ((x * 0x9E3779B1) & 0xFFFFFFFF) >> 12


def _trainer(folds: int):
    def train(block, trusted):
        return _trained(block, trusted, folds)

    return train


def _trained(block, trusted, folds: int):
    """5-gram counts of the block's training documents, and the fold that is to be scored with them."""
    table, ids = block, set(trusted["doc_id"].to_pylist())
    some = table.filter(pa.array([d in ids for d in table["doc_id"].to_pylist()], pa.bool_()))
    out = []
    for _, part in _runs(some):
        out.append(np.unique(_grams(part)[0], return_counts=True))
    g = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
    c = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
    fold = (block["block"][0].as_py() + 1) % folds if block.num_rows else 0
    return pa.table({"fold": pa.array(np.full(len(g), fold, np.int64)), "g": pa.array(g, pa.int64()), "c": pa.array(c, pa.int64())})


def _asker(shards: int, folds: int):
    def ask(block):
        grams = _distinct(block)
        number = block["block"][0].as_py()
        shard = _shard(grams, shards) * folds + number % folds
        order = np.argsort(shard, kind="stable")
        found, starts = np.unique(shard[order], return_index=True)
        parts = np.split(grams[order], starts[1:])
        payload = [pack(np.diff(p, prepend=0)) for p in parts] if len(found) else []
        return pa.table({
            "shard": pa.array(found, pa.int64()), "block": pa.array([number] * len(found), pa.int64()),
            "grams": pa.array(payload, pa.binary()),
        })

    return ask


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], 0.0), hit


def _pack_bits(bits: np.ndarray) -> bytes:
    """Bits of each gram to 16 binary digits, compressed byte plane by byte plane; texts' means are rounded far coarser."""
    rounded = ((bits.astype(np.float32).view(np.uint32) + np.uint32(0x80)) & np.uint32(0xFFFFFF00)).view(np.uint8)
    planes = np.ascontiguousarray(rounded.reshape(-1, 4)[:, 1:].T).tobytes()
    return len(bits).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack_bits(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 3 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, n)
    out = np.zeros((n, 4), np.uint8)
    out[:, 1:] = planes.T
    return out.view(np.float32).ravel()


def _answer(model, asked):
    """Bits of each asked 5-gram's last byte, from the shard's contexts of all orders."""
    orders = model["k"].to_numpy()
    tables = []
    for k in range(1, ORDER + 1):
        part = model.filter(pa.array(orders == k))
        h = part["h"].to_numpy()
        by = np.argsort(h)
        sizes = part["bytes"].combine_chunks().value_lengths().to_numpy() if len(h) else np.zeros(0, np.int64)
        w = part["bytes"].combine_chunks().flatten().to_numpy() if len(h) else np.zeros(0, np.int64)
        p = part["share"].combine_chunks().flatten().to_numpy() if len(h) else np.zeros(0)
        g = (np.repeat(h, sizes) << 8) | w
        to = np.argsort(g)
        tables.append((h[by], part["gamma"].to_numpy()[by], g[to], p[to]))
    out = []
    for packed in asked["grams"].to_pylist():
        grams = np.cumsum(unpack(packed))
        p = np.full(len(grams), 1 / 256)
        for k, (h, gamma, g, share) in enumerate(tables, 1):
            back, known = _lookup(h, gamma, (grams >> 8) & ((1 << 8 * (k - 1)) - 1))
            own, _ = _lookup(g, share, grams & ((1 << 8 * k) - 1))
            p = np.where(known, own + back * p, p)
        out.append(_pack_bits(-np.log2(p)))
    return pa.table({"block": asked["block"], "shard": asked["shard"], "bits": pa.array(out, pa.binary())})


def _worst(total: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The highest mean of WINDOW successive bytes of each text; of all bytes in a shorter text, 0 in an empty one."""
    sizes = np.diff(bounds)
    means = np.diff(total[bounds]) / np.maximum(sizes, 1)
    n = len(total) - 1
    if n < WINDOW or not (sizes >= WINDOW).any():
        return means
    inside = np.arange(n) + WINDOW <= np.repeat(bounds[1:], sizes)
    sums = np.full(n, -np.inf)
    sums[: n - WINDOW + 1] = total[WINDOW:] - total[:-WINDOW]
    sums[~inside] = -np.inf
    some = sizes > 0  # bounds of empty texts would cut no window
    highest = means.copy()
    highest[some] = np.maximum.reduceat(sums, bounds[:-1][some]) / WINDOW
    return np.where(sizes >= WINDOW, highest, means)


def _scorer(shards: int, folds: int):
    def score(block, answers):
        grams = _distinct(block)
        bits = np.zeros(len(grams), np.float32)
        fold = block["block"][0].as_py() % folds if block.num_rows else 0
        shard = _shard(grams, shards) * folds + fold
        for s, b in zip(answers["shard"].to_pylist(), answers["bits"].to_pylist()):
            bits[shard == s] = _unpack_bits(b)
        sums = np.zeros(block.num_rows)
        worst = np.zeros(block.num_rows)
        sizes = np.zeros(block.num_rows, np.int64)
        for start, part in _runs(block):
            own, bounds = _grams(part)
            codes, few = pd.factorize(own)
            total = np.r_[0.0, np.cumsum(bits[np.searchsorted(grams, few)].astype(np.float64)[codes])]
            sums[start : start + len(part)] = np.diff(total[bounds])
            worst[start : start + len(part)] = _worst(total, bounds)
            sizes[start : start + len(part)] = np.diff(bounds)
        per_byte = [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist())]
        return pa.table({
            "doc_id": block["doc_id"], "lang": block["lang"], "n_bytes": pa.array(sizes, pa.int64()),
            "bits": pa.array(per_byte, pa.float64()),
            "worst": pa.array([w if n else None for w, n in zip(worst.tolist(), sizes.tolist())], pa.float64()),
        })

    return score


def contexts(counts: DataFrame, shards: int, folds: int) -> DataFrame:
    """The models: shard, k, h, gamma, bytes, share. One row per fold and context h of each order k.

    `counts` has columns fold (that the model is for), g and c.

    Below the highest order a count is the number of distinct bytes seen before the
    n-gram. share is the discounted part of each byte seen after h, gamma the weight of the
    next lower order. A context has at most 256 bytes. Discounts come from the counts of
    counts of each order. Orders 1 and 2 are at most 65,793 rows and go to every shard.
    """
    levels = [counts.select("fold", F.lit(ORDER).alias("k"), "g", "c")]
    below = counts
    for k in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << 8 * k) - 1).cast("long")
        # Counting through `c` keeps the column, so that every user of a level reads one exchange.
        one = F.least(F.col("c"), F.lit(1))
        below = below.select("fold", F.col("g").bitwiseAND(mask).alias("g"), one.alias("c")).groupBy("fold", "g").agg(F.sum("c").alias("c"))
        levels.append(below.select("fold", F.lit(k).alias("k"), "g", "c"))
    every = levels[0]
    for other in levels[1:]:
        every = every.unionByName(other)
    n = [F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(i: int):
        own, nxt = F.col(f"n{i}"), F.col(f"n{i + 1}")
        found = F.when((own > 0) & (F.col("n1") > 0), i - (i + 1) * y * nxt / own)
        return F.least(F.greatest(F.coalesce(found, F.lit(0.5 * i)), F.lit(0.05)), F.lit(i - 0.05)).alias(f"d{i}")

    discounts = every.groupBy("fold", "k").agg(*n).select("fold", "k", *[discount(i) for i in (1, 2, 3)])
    seen = [F.count(F.when(t, 1)).alias(a) for a, t in (("s1", F.col("c") == 1), ("s2", F.col("c") == 2), ("s3", F.col("c") > 2))]
    grouped = every.groupBy("fold", "k", F.shiftright("g", 8).alias("h")).agg(
        F.sum("c").alias("total"), *seen,
        F.collect_list(F.struct(F.col("g").bitwiseAND(F.lit(255).cast("long")).alias("w"), "c")).alias("after"),
    )
    both = grouped.join(F.broadcast(discounts), ["fold", "k"])
    left = lambda a: a["c"] - F.when(a["c"] == 1, F.col("d1")).when(a["c"] == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = both.select(
        "fold", "k", "h",
        ((F.col("d1") * F.col("s1") + F.col("d2") * F.col("s2") + F.col("d3") * F.col("s3")) / F.col("total")).cast("float").alias("gamma"),
        F.transform("after", lambda a: a["w"]).alias("bytes"),
        # Single precision holds more digits than are kept of any text.
        F.transform("after", lambda a: (left(a) / F.col("total")).cast("float")).alias("share"),
    )
    own = F.shiftright((F.col("h").bitwiseAND(F.lit(0xFFFF).cast("long")) * 0x9E3779B1).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), 12) % shards
    to = F.when(F.col("k") > 2, F.array(own)).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    dealt = rows.select("fold", F.explode(to).alias("shard"), "k", "h", "gamma", "bytes", "share")
    return dealt.withColumn("shard", F.col("shard") * folds + F.col("fold")).drop("fold")


def bits_per_byte(docs: DataFrame, training: DataFrame, folds: int = 1) -> DataFrame:
    """doc_id, lang, n_bytes, bits and worst, one row per input row.

    bits are per byte of the text, worst are those of its worst window; both are null for an empty or null text.
    `training` holds the doc_id of the documents to learn from. With two folds every text,
    in `training` or not, is scored by a model of the training documents in the other fold,
    so no text meets a model that has seen it; with one fold by a model of them all. Texts
    are dealt into blocks of one fold each once; learning, asking and scoring share that
    exchange. Without a training document every byte costs 8 bits; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (BLOCK_BYTES * folds)))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // folds)

    def number(c: Column) -> Column:
        fold = F.pmod(F.xxhash64(c, F.lit("half")), F.lit(folds))
        return (F.pmod(F.xxhash64(c), F.lit(blocks)) * folds + fold).alias("block")

    # Without an id there is no label to meet, and a hash of the text spreads such rows.
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.col("doc_id"))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"), number(key)
    )
    rows = rows.mapInArrow(_squeeze, "doc_id long, lang string, text binary, block long").repartition("block")
    trusted = training.select("doc_id", number(F.col("doc_id"))).filter("doc_id is not null")
    # Below, every user of `rows` reads the same exchange.
    counted = rows.groupBy("block").cogroup(trusted.groupBy("block")).applyInArrow(_trainer(folds), "fold long, g long, c long")
    model = contexts(counted.groupBy("fold", "g").agg(F.sum("c").alias("c")), shards, folds)
    asked = rows.groupBy("block").applyInArrow(_asker(shards, folds), "shard long, block long, grams binary")
    answers = model.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_answer, "block long, shard long, bits binary")
    return (
        rows.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_scorer(shards, folds), "doc_id long, lang string, n_bytes long, bits double, worst double")
    )


def thresholds(held: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, dict[str, float | None]]:
    """(of, limit_bits, limit_worst) per language of `held`, and the limits of a language that has no text there.

    A limit is a mean of two: the language's own quantile, weighing as many texts as it has,
    and its median plus the distance of the quantile from the median over all languages,
    weighing COMMON_WEIGHT. The median leans on that of all texts by MEDIAN_WEIGHT. So a
    limit moves smoothly with the number of texts, at every number.
    """
    of = F.coalesce("lang", F.lit("")).alias("of")
    counts = held.groupBy(of, *MEASURES).agg(F.count(F.lit(1)).alias("n"))
    at = lambda m, q: F.percentile(m, F.lit(q), F.col("n"))
    middle = counts.agg(*[at(m, 0.5).alias(m) for m in MEASURES]).first()
    own = [a for m in MEASURES for a in (at(m, quantile).alias(f"own_{m}"), at(m, 0.5).alias(f"middle_{m}"))]
    per = counts.groupBy("of").agg(F.sum("n").alias("held"), *own)
    if middle[0] is None:
        return per.select("of", *[F.lit(None).cast("double").alias(f"limit_{m}") for m in MEASURES]), dict.fromkeys(MEASURES)

    def median(m: str) -> Column:
        return (F.col("held") * F.col(f"middle_{m}") + MEDIAN_WEIGHT * F.lit(middle[m])) / (F.col("held") + MEDIAN_WEIGHT)

    per = per.select("of", "held", *[f"own_{m}" for m in MEASURES], *[median(m).alias(f"middle_{m}") for m in MEASURES])
    per = materialize(per)
    beside = counts.join(broadcast_if_small(per), "of")
    above = beside.groupBy(*[F.round(F.col(m) - F.col(f"middle_{m}"), DIGITS).alias(m) for m in MEASURES]).agg(F.sum("n").alias("n"))
    common = above.agg(*[at(m, quantile).alias(m) for m in MEASURES]).first()

    def limit(m: str) -> Column:
        lent = F.col(f"middle_{m}") + F.lit(common[m])
        return (F.col("held") * F.col(f"own_{m}") + COMMON_WEIGHT * lent) / (F.col("held") + COMMON_WEIGHT)

    limits = per.select("of", *[limit(m).alias(f"limit_{m}") for m in MEASURES])
    return limits, {m: middle[m] + common[m] for m in MEASURES}


def classify(docs: DataFrame, labels: DataFrame, *, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold, kept, worst and worst_threshold, one row per row of `docs`.

    Trusted documents are those labelled with quality 1 and not toxic. The documents are cut
    into two folds by a hash of the id; the trusted ones of either train the model that scores
    the other, so every text is scored by a model that has not seen it, and all trusted
    ones set the thresholds (see `thresholds`). Perplexity is per byte, worst is that of the
    worst window; a text above either threshold is not kept. A null or empty text has
    none and is not kept. Null languages form one of their own. Without trusted documents
    there is no threshold and all texts are kept. Repeated rows are scored each for itself;
    an empty table gives no rows.
    """
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    scored = bits_per_byte(docs, trusted, FOLDS)
    scored = materialize(scored.withColumns({m: F.round(m, DIGITS) for m in MEASURES}))
    held = scored.filter("bits is not null").join(trusted, "doc_id", "left_semi")
    per, elsewhere = thresholds(held, quantile)
    limits = [F.coalesce(F.col(f"limit_{m}"), F.lit(elsewhere[m]).cast("double")) for m in MEASURES]
    joined = scored.join(broadcast_if_small(per), F.coalesce("lang", F.lit("")) == F.col("of"), "left")
    under = [F.col(m) <= F.coalesce(l, F.lit(float("inf"))) for m, l in zip(MEASURES, limits)]
    power = lambda bits: F.pow(F.lit(2.0), bits)
    return joined.select(
        "doc_id", "lang", "n_bytes", power(F.col("bits")).alias("perplexity"), power(limits[0]).alias("threshold"),
        F.coalesce(under[0] & under[1], F.lit(False)).alias("kept"),
        power(F.col("worst")).alias("worst"), power(limits[1]).alias("worst_threshold"),
    )
