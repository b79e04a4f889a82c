"""All registered queries: name -> (query, SQL that gives the same rows, or None)."""

from __future__ import annotations

from sluiceway.plans import admission_queries, stream_queries, streaming_queries, wire_queries

QUERIES = {
    **wire_queries.QUERIES,
    **stream_queries.QUERIES,
    **admission_queries.QUERIES,
    **streaming_queries.QUERIES,
}
