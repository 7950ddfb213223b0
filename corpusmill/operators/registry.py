"""The queries of the library's own operators and their SQL."""

from __future__ import annotations

from corpusmill.operators import queries_layout, queries_retrieval, queries_text, queries_urls  # noqa: F401  (registers its queries)
from corpusmill.operators.catalogue import ORACLES, QUERIES


def entry(spark, sf_dir):
    return QUERIES["flagship_chunk_search"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
