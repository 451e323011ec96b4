from .pipeline import (
    Measure,
    append_and_reject,
    complete_transactions,
    dedupe_stream,
    fan_out_stream,
    fold_rollup,
    fold_transactions,
    late_rows,
    open_transactions,
    read_rollup,
    rollup_parts,
    rollup_to_lake,
    run_stream,
    stream_rollup,
    stream_to_lake,
    stream_transactions_to_lake,
)

__all__ = [name for name in dir() if not name.startswith("_")]
