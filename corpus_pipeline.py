"""Corpus preparation: from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language_id, line_spread, mixing, pieces, simhash
from millrace.llm.common import unpacked
from millrace.operators.lineage import materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough; `lang` becomes the language found."""
    found = language_id.identify(language_id.document_evidence(docs, docs.columns)).filter("accepted")
    return unpacked(found, docs.columns, lang=F.col("language"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sources share; a line stays where it came first."""
    return line_spread.without_boilerplate(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_pieces, round_trip of every document of the mix."""
    return pieces.encode_documents(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: Trained likelihoods, 64-bit hashes and the piece search have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
