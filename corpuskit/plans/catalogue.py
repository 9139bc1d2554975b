"""Every query by name, with its DuckDB equivalent."""

from __future__ import annotations

from corpuskit.plans import build_queries, io_queries, more_queries, text_queries, vector_queries

QUERIES: dict = {**text_queries.QUERIES, **vector_queries.QUERIES, **more_queries.QUERIES, **build_queries.QUERIES, **io_queries.QUERIES}
ORACLES: dict[str, str] = {**text_queries.ORACLES, **vector_queries.ORACLES, **more_queries.ORACLES, **build_queries.ORACLES, **io_queries.ORACLES}
