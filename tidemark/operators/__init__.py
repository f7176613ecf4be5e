from .checks import change_log_gaps, duplicate_keys, orphans, position_bounds, range_chain
from .history import (
    append_versions,
    current_flag,
    latest_batch,
    latest_per_key,
    unprocessed_batches,
    validity,
)
from .ingest import (
    select_changes,
    select_columns,
    select_incremental,
    with_audit_columns,
)
from .merge import (
    align_to_target,
    change_delete_flag,
    default_delete_flag,
    drop_change_columns,
    merge_changes,
    merge_upsert,
    newest_changes,
    relevant_changes,
    soft_delete_flag,
)

__all__ = [
    "align_to_target",
    "append_versions",
    "change_delete_flag",
    "change_log_gaps",
    "current_flag",
    "default_delete_flag",
    "drop_change_columns",
    "duplicate_keys",
    "latest_batch",
    "latest_per_key",
    "merge_changes",
    "merge_upsert",
    "newest_changes",
    "orphans",
    "position_bounds",
    "range_chain",
    "relevant_changes",
    "select_changes",
    "select_columns",
    "select_incremental",
    "soft_delete_flag",
    "unprocessed_batches",
    "validity",
    "with_audit_columns",
]
