from . import lake_queries, report_queries, sink_queries, source_queries, stream_queries, table_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "lake_queries", "report_queries", "sink_queries", "source_queries", "stream_queries", "table_queries"]
