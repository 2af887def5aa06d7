"""Named queries over the driver's tables, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from . import stream_queries, table_queries, turn_queries

QUERIES = {**turn_queries.QUERIES, **table_queries.QUERIES, **stream_queries.QUERIES}
ORACLE_SQL = {**turn_queries.ORACLE_SQL, **table_queries.ORACLE_SQL, **stream_queries.ORACLE_SQL}
