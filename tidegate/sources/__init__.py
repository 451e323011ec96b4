from .backfill import SplitPlan, plan_even_splits, range_predicates, read_jdbc_snapshot, read_snapshot, split_count, uneven_edges
from .cdc import current_documents, current_rows, decode_changes, with_metadata
from .config import DatabaseSource, KafkaSource, MongoSource, MySqlSource, PostgresSource, SqlServerSource
from .decode import (
    accepted,
    decode_bytes,
    decode_canal,
    decode_csv,
    decode_debezium,
    decode_json,
    decode_key,
    decode_maxwell,
    decode_upsert,
    documents,
    rejected,
)
from .feed import (
    FEED_SCHEMA,
    after_offsets,
    end_offsets,
    from_timestamp,
    header_value,
    metadata_columns,
    read_recorded,
    read_topic,
)

__all__ = [name for name in dir() if not name.startswith("_")]
