"""Queries of the operators that compare or score documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import alignment, kneser_ney, language_id, long_matches, phrases, pieces, simhash
from millrace.llm.registry import query
from millrace.session import Tables


@query("op2_language_id")
def op2_language_id(t: Tables):
    found = language_id.identify(language_id.document_evidence(t.documents, ["doc_id", "lang"]))
    return found.select("row.doc_id", F.col("row.lang").alias("declared"), "language", "posterior", F.col("accepted").alias("kept"))


@query("page_languages")
def page_languages(t: Tables):
    found = language_id.identify(language_id.page_evidence(t.pages))
    return found.select("row.page_id", "language", "posterior", "accepted")


@query("op6_sentencepiece")
def op6_sentencepiece(t: Tables):
    return pieces.encode_documents(t.documents)


@query("op8_simhash")
def op8_simhash(t: Tables):
    found = simhash.grouped(t.documents)
    return found.select("doc_id", simhash.spelled(F.col("fp")).alias("fingerprint"), "component_id")


@query("op9_document_fingerprints")
def op9_document_fingerprints(t: Tables):
    return phrases.fingerprint_documents(t.documents.select("doc_id", "text"))


@query("op10_quality_model")
def op10_quality_model(t: Tables):
    return kneser_ney.classify(t.documents, t.labels)


@query("op3_suffix_dedup")
def op3_suffix_dedup(t: Tables):
    return long_matches.without_repeats(t.documents.select("doc_id", "text"))


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(t: Tables):
    return alignment.align_documents(t.documents)
