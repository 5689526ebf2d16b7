"""DataFrame -> DataFrame operators."""

from orderlens.operators.checks import assert_unique, duplicate_keys, reconcile, reconcile_tree, with_counts
from orderlens.operators.derive import with_serial_key
from orderlens.operators.filters import exclude_values, keep_flagged_or_unflagged
from orderlens.operators.joins import (
    exclude_existing, exclude_keys, exists_flag, exists_flags, expand_by_list, join_latest, join_on_expr,
    keep_keys, left_join_filtered, left_join_many, or_join, prefix_lookup,
)
from orderlens.operators.latest import (
    distinct_with_group_max, group_max, latest_per_key, strict_latest,
)
from orderlens.operators.merge import (
    append_by_name, changed_since, delete_missing, incremental_refresh, merge_upsert, recent,
)
from orderlens.operators.skew import find_hot_keys, join_to_one
from orderlens.operators.pivot import (
    category_bitmaps, category_values, fill_zero, joined_list, pivot_flags, pivot_values,
)

__all__ = [
    "assert_unique", "duplicate_keys", "reconcile", "reconcile_tree", "with_counts", "exclude_values",
    "keep_flagged_or_unflagged", "exclude_existing", "exclude_keys", "expand_by_list",
    "exists_flag", "exists_flags", "join_latest", "join_on_expr", "keep_keys", "left_join_filtered",
    "left_join_many",
    "or_join", "prefix_lookup", "distinct_with_group_max", "group_max", "latest_per_key",
    "strict_latest", "append_by_name", "changed_since", "delete_missing",
    "incremental_refresh", "merge_upsert", "recent", "category_values", "fill_zero",
    "category_bitmaps", "joined_list", "pivot_flags", "pivot_values", "with_serial_key", "find_hot_keys",
    "join_to_one",
]
