"""Language identification by Bayesian fusion of evidence.

The posterior of a language is its prior at the document's host, times the likelihood of
the text, of the declared markup language and of the address suffix. Host priors are
smoothed down a hierarchy: a host leans on its domain, the domain on its suffix, the
suffix on the whole corpus. All tables come from grouped aggregation over all documents.
Languages with few documents share one class; a second pass tells them apart in the
documents that this class wins. A background class stands for everything else, noise
and unknown languages: it expects the same trigrams as the languages, but by far less
sharply, so a text wins over it only with trigrams that its language prefers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import release, slices
from millrace.operators.lineage import materialize
from millrace.operators.sizing import broadcast_if_small

#: Byte trigrams are hashed to so many cells.
CELLS = 1 << 16
#: A text counts as at most so many independent trigrams, as overlapping ones repeat each other.
EVIDENCE = 200
#: Declared languages with a smaller share of all documents share a class and are told apart in a second pass.
LEAST_SHARE = 0.001
#: Documents that a parent of the host hierarchy counts for.
PRIOR_WEIGHT = 10.0
#: Prior of the background class.
PRIOR_BACKGROUND = 0.001
#: The background is the languages' mean raised to this power, and a share of all cells alike.
FLATNESS = 0.5
EVEN_SHARE = 0.3
#: A document whose best language has a smaller posterior is rejected.
LEAST_POSTERIOR = 0.5
#: Letters that a text needs.
LEAST_LETTERS = 1
#: Bytes a worker looks at in one array.
CHUNK = 1 << 20


def _cells(text: bytes) -> np.ndarray:
    """Cell of the byte trigram that starts at each byte but the last two."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def _joined(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Runs of texts as one byte string each, with the bounds of every text in it.

    Texts are lower-cased; digits and punctuation become blanks, so only words count.
    """
    for part in slices(texts, CHUNK):
        yield _run([_letters(t) for t in part.to_pylist()])


_BLANKS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def _letters(text: str | None) -> bytes:
    found = (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANKS).split()
    return b" " + b" ".join(found) + b" " if found else b""


def _run(part: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in part], np.int64)
    starts = np.cumsum(sizes + 2) - sizes - 2
    return b"\0\0".join(part) + b"\0\0", starts, np.maximum(starts, starts + sizes - 2)


def _counter(languages: list[str], n: int):
    """Per task: class, cell, n over all its texts; languages that are not listed are the last of the n classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, CELLS), np.int64)
        number = {l: i for i, l in enumerate(languages)}
        for batch in batches:
            classes = np.array([number.get(d, n - 1) for d in batch.column(0).to_pylist()], np.int64)
            at = 0
            for text, starts, ends in _joined(batch.column(1)):
                of = classes[at : at + len(starts)]
                at += len(starts)
                cells = _cells(text)
                for c in np.unique(of):
                    inside = np.zeros(len(text) + 1, np.int8)
                    np.add.at(inside, starts[of == c], 1)
                    np.add.at(inside, ends[of == c], -1)
                    total[c] += np.bincount(cells[np.cumsum(inside[: len(cells)], dtype=np.int8) > 0], minlength=CELLS)
        release()
        c, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(cell), pa.array(total[c, cell])], ["class", "cell", "n"])

    return count


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, cell, n and size (the trigrams of the text) of each distinct cell of each text."""
    for batch in batches:
        at = 0
        for text, starts, ends in _joined(batch.column(1)):
            cells = _cells(text)
            own = [np.unique(cells[a:b], return_counts=True) for a, b in zip(starts, ends)]
            lengths = [len(c) for c, _ in own]
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(at, at + len(own)), lengths)))
            at += len(own)
            columns = [np.concatenate([c for c, _ in own]), np.concatenate([n for _, n in own]), np.repeat(ends - starts, lengths)]
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(x, pa.int64()) for x in columns]], ["key", "cell", "n", "size"])
    release()


def declared_languages(evidence: DataFrame) -> tuple[list[str], int]:
    """The declared languages with at least LEAST_SHARE of the declared documents, and the number of all others.

    At most 1 / LEAST_SHARE languages are listed.
    """
    counts = evidence.filter("declared is not null").groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    total, every = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    some = counts.filter(F.col("n") >= (total or 0) * LEAST_SHARE).select("declared")
    found = sorted(r[0] for r in some.collect())
    return found, every - len(found)


def text_model(evidence: DataFrame, languages: list[str], n: int) -> np.ndarray:
    """Log-likelihood of a trigram cell under each of n classes, from all documents that declare a language.

    The classes are `languages` and, where n is larger, one of all others. Tasks count into
    arrays of a fixed size, which are summed by an aggregation; the driver gets one array
    per class, whatever the size of the corpus.
    """
    some = evidence.filter("declared is not null").select("declared", "text")
    counts = (
        some.mapInArrow(_counter(languages, n), "class long, cell long, n long")
        .groupBy("class", "cell").agg(F.sum("n").alias("n"))
    ).toArrow()
    table = np.full((n, CELLS), 0.5)
    table[counts["class"].to_numpy(), counts["cell"].to_numpy()] += counts["n"].to_numpy()
    return np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def background(table: np.ndarray) -> np.ndarray:
    """Log-likelihood of a cell under the background, from those under the classes."""
    flat = np.exp(table.astype(np.float64)).mean(0) ** FLATNESS
    return np.log((1 - EVEN_SHARE) * flat / flat.sum() + EVEN_SHARE / CELLS).astype(np.float32)


def text_scores(text: Column, model) -> Column:
    """Log-likelihoods of each text, one per row of the model, for at most EVIDENCE trigrams; 0 without any."""

    @F.arrow_udf(T.ArrayType(T.DoubleType(), False))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value
        for texts in batches:
            out = [np.zeros((0, len(table)))]
            for joined, starts, ends in _joined(texts):
                cells = _cells(joined)
                n = ends - starts
                bounds = np.c_[starts, np.maximum(ends, starts + 1)].ravel()
                sums = [np.add.reduceat(np.r_[t[cells], np.float32(0)], np.minimum(bounds, len(cells)), dtype=np.float64)[::2] for t in table]
                mean = np.stack(sums, 1) / np.maximum(n, 1)[:, None]
                out.append(mean * np.minimum(n, EVIDENCE)[:, None])
            scores = np.concatenate(out)
            bounds = np.arange(len(scores) + 1, dtype=np.int32) * np.int32(len(table))
            yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(scores.ravel()))
        release()

    return score(text)


def _best(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def _tally(rows: DataFrame, key: str, n: int) -> DataFrame:
    """key and `counts`: how many documents of the key each language wins by text alone."""
    counts = F.array(*[F.count(F.when(F.col("by_text") == i, 1)) for i in range(n)])
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(counts.alias("counts"))


def _smoothed(counts: Column, parent: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + PRIOR_WEIGHT * p) / (total + PRIOR_WEIGHT))


def host_priors(scored: DataFrame, n: int) -> DataFrame:
    """host, prior: the languages' shares at the host, smoothed by domain, suffix and corpus."""
    voters = scored.filter("by_text is not null")
    whole = voters.agg(*[F.count(F.when(F.col("by_text") == i, 1)) for i in range(n)]).first()
    corpus = F.array(*[F.lit((c + 1.0) / (sum(whole) + n)) for c in whole])
    suffixes = _tally(voters, "suffix", n).select("suffix", _smoothed(F.col("counts"), corpus).alias("of_suffix"))
    chain = voters.filter("host is not null").groupBy("host").agg(F.max("domain").alias("domain"), F.max("suffix").alias("suffix"))
    domains = (
        _tally(voters, "domain", n)
        .join(chain.filter("domain is not null").groupBy("domain").agg(F.max("suffix").alias("suffix")), "domain")
        .join(suffixes, "suffix", "left")
        .select("domain", _smoothed(F.col("counts"), F.coalesce("of_suffix", corpus)).alias("of_domain"))
    )
    return (
        _tally(voters, "host", n)
        .join(chain, "host")
        .join(domains, "domain", "left")
        .select("host", _smoothed(F.col("counts"), F.coalesce("of_domain", corpus)).alias("prior"))
    )


def _reliability(voters: DataFrame, key: str, n: int) -> DataFrame:
    """key and `given`: log P(value | language), from how often texts of a language carry the value."""
    tally = _tally(voters, key, n)
    sums = tally.agg(F.count(F.lit(1)), *[F.sum(F.col("counts")[i]) for i in range(n)]).first()
    values = sums[0] + 1
    logs = [F.log((F.col("counts")[i] + 1.0) / F.lit(float((sums[1 + i] or 0) + values))) for i in range(n)]
    return tally.select(key, F.array(*logs).alias(f"given_{key}"))


def _counted(rows: DataFrame, wins: DataFrame, key: str) -> DataFrame:
    """`rows` with both_<key>, the wins of its language at its key, and all_<key>, all wins at its key."""
    at = wins.filter(F.col(key).isNotNull())
    both = at.groupBy(key, "of").agg(F.count(F.lit(1)).alias(f"both_{key}"))
    every = at.groupBy(key).agg(F.count(F.lit(1)).alias(f"all_{key}"))
    out = rows.join(broadcast_if_small(both), [key, "of"], "left").join(broadcast_if_small(every), key, "left")
    return out.fillna(0, [f"both_{key}", f"all_{key}"])


def among_rare(won: DataFrame, rare: DataFrame, n: int) -> DataFrame:
    """uid, language, among (its share among them): the best of the n languages declared in `rare`, for each row of `won`.

    Fuses the same evidence as the first pass. Trigram counts and tallies stay distributed
    and hold a row per language and value met, so the number of languages is not bounded.
    A language that shares no trigram with a text is no candidate for it.
    """
    shape = "cell long, n long, size long"
    texts = rare.select("declared", "text").mapInArrow(_cells_of, f"key string, {shape}")
    counts = materialize(texts.groupBy(F.col("key").alias("of"), "cell").agg(F.sum("n").alias("n")))
    weights = counts.select("of", "cell", F.log((F.col("n") + 0.5) / 0.5).alias("weight"))
    bases = counts.groupBy("of").agg(F.log(0.5 / (F.sum("n") + 0.5 * CELLS)).alias("base"))
    cells = won.select("uid", "text").mapInArrow(_cells_of, f"key long, {shape}")
    sums = (
        cells.join(broadcast_if_small(weights), "cell")
        .groupBy(F.col("key").alias("uid"), "of")
        .agg(F.sum(F.col("n") * F.col("weight")).alias("sum"), F.max("size").alias("size"))
        .join(broadcast_if_small(bases), "of")
    )
    by_text = (F.col("sum") / F.col("size") + F.col("base")) * F.least("size", F.lit(EVIDENCE))
    places = won.select("uid", "declared", "host", "domain", "suffix")
    rows = materialize(sums.select("uid", "of", by_text.alias("likelihood")).join(places, "uid"))
    best = rows.groupBy("uid").agg(F.min_by("of", F.struct(-F.col("likelihood"), "of")).alias("of"))
    wins = materialize(best.join(places, "uid"))
    total, values, suffixes = wins.agg(F.count(F.lit(1)), F.count_distinct("declared"), F.count_distinct("suffix")).first()
    for key in ("host", "domain", "suffix", "declared"):
        rows = _counted(rows, wins, key)
    own = wins.groupBy("of").agg(F.count(F.lit(1)).alias("own"))
    rows = rows.join(broadcast_if_small(own), "of", "left").fillna(0, ["own"])
    prior = (F.col("own") + 1.0) / (total + n)
    for key in ("suffix", "domain", "host"):
        prior = (F.col(f"both_{key}") + PRIOR_WEIGHT * prior) / (F.col(f"all_{key}") + PRIOR_WEIGHT)
    fused = F.col("likelihood") + F.when(F.col("host").isNull(), 0.0).otherwise(F.log(prior))
    for key, known in (("declared", values), ("suffix", suffixes)):
        given = F.log((F.col(f"both_{key}") + 1.0) / (F.col("own") + known + 1))
        fused = fused + F.when(F.col(key).isNull(), 0.0).otherwise(given)
    scored = rows.select("uid", "of", fused.alias("fused"))
    tops = scored.groupBy("uid").agg(
        F.min_by("of", F.struct(-F.col("fused"), "of")).alias("language"), F.max("fused").alias("top"), F.collect_list("fused").alias("all")
    )
    share = F.lit(1.0) / F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    return tops.select("uid", "language", share.alias("among"))


def with_address(url: Column) -> dict[str, Column]:
    """host, domain and suffix of an address; null parts where it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return address_parts(F.when(host != "", host))


def address_parts(host: Column) -> dict[str, Column]:
    labels = F.split(host, r"\.", -1)
    dotted = F.size(labels) > 1
    return {
        "host": host,
        "domain": F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")),
        "suffix": F.when(dotted, F.element_at(labels, -1)),
    }


def identify(evidence: DataFrame) -> DataFrame:
    """The rows of `evidence` with language, posterior and accepted.

    `evidence` has text, declared, host, domain, suffix (string, any null) and a struct
    `row` that is carried along. Null or unknown declarations, addresses and hosts are no
    evidence either way. A text with fewer than LEAST_LETTERS letters gets no language and is rejected,
    as is one whose best language has a posterior under LEAST_POSTERIOR beside the other
    languages and the background; a text that the background explains better than every
    language has no vote in host priors. Ties go to the language first in the alphabet.
    An empty table gives no rows. If nothing declares a language, every row is rejected. Rows are never
    joined on an id, so repeated rows and ids do not matter. Languages under LEAST_SHARE
    compete as one class; the posterior of one of them is the class's times its share in it.
    """
    spark = evidence.sparkSession
    languages, others = declared_languages(evidence)
    n = len(languages) + (others > 0)
    if not n:
        return evidence.select(
            "row", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted")
        )
    table = text_model(evidence, languages, n)
    model = spark.sparkContext.broadcast(np.vstack([table, background(table)]))
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"\P{L}+", "")) >= LEAST_LETTERS
    scores = text_scores(F.col("text"), model)
    carried = ["declared", "host", "domain", "suffix"] + ["text"] * (others > 0)
    scored = evidence.select("row", *carried, letters.alias("letters"), scores.alias("scores"))
    scored = scored.select(
        "row", *carried, "letters", F.slice("scores", 1, n).alias("likelihood"), F.element_at("scores", -1).alias("unknown")
    )
    explained = F.col("letters") & (F.array_max("likelihood") >= F.col("unknown"))
    scored = materialize(scored.withColumn("by_text", F.when(explained, _best(F.col("likelihood")))))
    voters = scored.filter("by_text is not null")
    joined = (
        scored.join(broadcast_if_small(host_priors(scored, n)), "host", "left")
        .join(broadcast_if_small(_reliability(voters, "declared", n)), "declared", "left")
        .join(broadcast_if_small(_reliability(voters, "suffix", n)), "suffix", "left")
    )
    even = F.array_repeat(F.lit(1.0 / n), n)
    nothing = F.array_repeat(F.lit(0.0), n)
    fused = F.transform(F.coalesce("prior", even), lambda p: F.log(p))
    for part in ("likelihood", "given_declared", "given_suffix"):
        fused = F.zip_with(fused, F.coalesce(F.col(part), nothing), lambda a, b: a + b)
    # The background takes a declaration or suffix as the languages do on average.
    unknown = F.col("unknown") + float(np.log(PRIOR_BACKGROUND))
    for part in ("given_declared", "given_suffix"):
        mean = F.aggregate(part, F.lit(0.0), lambda a, x: a + F.exp(x)) / n
        unknown = unknown + F.coalesce(F.log(mean), F.lit(0.0))
    summed = joined.select("row", *carried, "letters", fused.alias("fused"), unknown.alias("unknown"))
    top = F.greatest(F.array_max("fused"), F.col("unknown"))
    total = F.aggregate("fused", F.exp(F.col("unknown") - top), lambda a, x: a + F.exp(x - top))
    share = F.exp(F.array_max("fused") - top) / total
    names = F.array(*[F.lit(l) for l in languages], *[F.lit(None).cast("string")] * (others > 0))
    accepted = (F.col("letters") & F.col("language").isNotNull() & (F.col("posterior") >= LEAST_POSTERIOR)).alias("accepted")
    decided = summed.select(
        "row", "letters", *carried,
        F.when(F.col("letters"), F.get(names, _best(F.col("fused")))).alias("language"),
        F.when(F.col("letters"), share).otherwise(0.0).alias("posterior"),
    )
    if not others:
        return decided.select("row", "language", "posterior", accepted)
    pooled = F.col("letters") & F.col("language").isNull()
    won = materialize(decided.filter(pooled).drop("language").withColumn("uid", F.monotonically_increasing_id()))
    rare = evidence.filter(F.col("declared").isNotNull() & ~F.col("declared").isin(languages))
    told = won.join(among_rare(won, rare, others), "uid", "left").withColumn(
        "posterior", F.coalesce(F.col("posterior") * F.col("among"), F.lit(0.0))
    )
    every = decided.filter(~pooled).unionByName(told.select(decided.columns))
    return every.select("row", "language", "posterior", accepted)


def document_evidence(docs: DataFrame, row: list[str]) -> DataFrame:
    """Documents as evidence: `lang` is the declared language, `source` the host."""
    return docs.select(
        F.struct(*[docs[c] for c in row]).alias("row"), docs["text"].alias("text"), F.lower(docs["lang"]).alias("declared"),
        *[v.alias(k) for k, v in address_parts(F.lower(docs["source"])).items()],
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Web pages as evidence: the html tag's language, the address, and the text between tags."""
    html = pages["html"]
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    tag = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        F.struct("page_id").alias("row"), text.alias("text"), F.when(tag != "", tag).alias("declared"),
        *[v.alias(k) for k, v in with_address(pages["url"]).items()],
    )
