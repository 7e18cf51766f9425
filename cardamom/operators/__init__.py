"""DataFrame-to-DataFrame building blocks."""

from cardamom.operators.aggregates import (
    daily_totals,
    last_value_row,
    per_key_totals,
    top_row,
)
from cardamom.operators.joins import (
    keep_matching,
    keep_unmatched,
    left_join_unique,
    left_with_default,
    lookup,
    lookup_table,
)
from cardamom.operators.maintenance import (
    create_empty,
    delete_where,
    drop_columns,
    insert_rows,
    retype,
    set_where,
)
from cardamom.operators.quality import (
    Rule,
    duplicate_keys,
    first_failure,
    key_counts,
    missing_keys,
    orphans,
    row_count_check,
    split_valid,
)
from cardamom.operators.ranking import number_rows, nth_row, preview, top_k
from cardamom.operators.records import chunk_records, tagged_union
from cardamom.operators.windows import (
    first_n_per_key,
    group_mean,
    previous_value,
    running_total,
)

__all__ = [
    "Rule",
    "chunk_records",
    "create_empty",
    "daily_totals",
    "delete_where",
    "drop_columns",
    "duplicate_keys",
    "first_failure",
    "first_n_per_key",
    "group_mean",
    "insert_rows",
    "keep_matching",
    "keep_unmatched",
    "key_counts",
    "last_value_row",
    "left_join_unique",
    "left_with_default",
    "lookup",
    "lookup_table",
    "missing_keys",
    "nth_row",
    "number_rows",
    "orphans",
    "per_key_totals",
    "preview",
    "previous_value",
    "retype",
    "row_count_check",
    "running_total",
    "set_where",
    "split_valid",
    "tagged_union",
    "top_k",
    "top_row",
]
