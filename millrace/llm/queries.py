"""All corpus queries. Importing the modules fills the registry."""

from __future__ import annotations

from millrace.llm import queries_pairs, queries_runs, queries_text, queries_urls  # noqa: F401
from millrace.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
