"""Every operator as a query on the test tables, with SQL which gives the same rows."""

from . import page_queries, text_queries, topic_queries, trend_queries

_PARTS = (trend_queries, text_queries, page_queries, topic_queries)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
