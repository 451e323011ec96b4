"""Change-data ingestion and delivery on Spark."""

from .connect import CapturedTable, Ingest
from .functions import map_type, split_rejects, typed_projection
from .operators import (
    ColumnSelection,
    TableColumns,
    TableSelector,
    apply_events,
    apply_latest,
    collapse,
    selection_findings,
)
from .session import build_session, shared_dir, work_path
from .sinks import FileSink, JdbcSink, LakeSink, LakeTable, SearchSink, deliver_tables, write_files, write_jdbc
from .sources import KafkaSource, MongoSource, MySqlSource, PostgresSource, SqlServerSource
from .topic import Topic

__all__ = [
    "CapturedTable",
    "ColumnSelection",
    "FileSink",
    "Ingest",
    "JdbcSink",
    "KafkaSource",
    "LakeSink",
    "LakeTable",
    "MongoSource",
    "MySqlSource",
    "PostgresSource",
    "SearchSink",
    "SqlServerSource",
    "TableColumns",
    "TableSelector",
    "Topic",
    "apply_events",
    "apply_latest",
    "build_session",
    "collapse",
    "deliver_tables",
    "map_type",
    "selection_findings",
    "shared_dir",
    "split_rejects",
    "typed_projection",
    "work_path",
    "write_files",
    "write_jdbc",
]
