from .changes import (
    apply_events,
    apply_latest,
    collapse,
    flatten_events,
    mark_transactions,
    snapshot_then_log,
    split_key_changes,
    split_transactions,
    split_unkeyed,
    to_append_only,
    transaction_sizes,
)
from .evolve import conform, evolve_union, evolved_schema, wider_type
from .profile import candidate_keys, collection_stats, column_profile, feed_profile, table_profile
from .quality import not_null_violations, pk_violations, selection_findings, split_not_null
from .selection import (
    ColumnSelection,
    TableColumns,
    TableSelector,
    glob_regex,
    missing_tables,
    pattern_condition,
    project_columns,
    require_tables,
    resolve_specific,
    select_specific,
    tables_condition,
)
from .skew import bring_together, join_by_key, salt_hot_keys

__all__ = [name for name in dir() if not name.startswith("_")]
