from .config import FileSink, JdbcSink, LakeSink, SearchSink
from .encode import encode_debezium, encode_plain, encode_upsert, wire_row
from .fanout import deliver_tables, fan_out, fan_out_table, sink_input
from .files import read_files, stream_files, write_files
from .jdbc import append_rows, merge_statements, upsert_rows, write_jdbc
from .lake import LakeTable, append_table, merge_sql, upsert_table
from .search import (
    bulk_docs,
    deliver,
    document_id,
    ndjson,
    number_batches,
    pack_requests,
    prepare,
    route,
    send_requests,
    split_unkeyed_docs,
    split_unknown_fields,
    write_ndjson,
)

__all__ = [name for name in dir() if not name.startswith("_")]
