from portolan.operators.columns import (
    doubles_to_int,
    drop_columns,
    drop_sparse,
    rename_columns,
    select_columns,
    sparse_columns,
)
from portolan.operators.dedup import dedup, dedup_rare, keep_one
from portolan.operators.exact import exact_average
from portolan.operators.groups import average_by, distinct_values, preview, row_counts
from portolan.operators.joins import broadcast_limit, fits_broadcast, lookup_join, measured_bytes
from portolan.operators.keys import add_dense_key, dense_key_by_range, dense_key_small, merge_dimension
from portolan.operators.profile import (
    cleaning_loss,
    counted_loss,
    dedup_loss,
    dropna_loss,
    key_counts,
    null_percent,
    null_profile,
)
from portolan.operators.quality import check_not_empty, check_not_null, check_references, check_unique, raise_on_failure
from portolan.operators.rows import drop_missing

__all__ = [
    "add_dense_key",
    "average_by",
    "broadcast_limit",
    "check_not_empty",
    "check_not_null",
    "check_references",
    "check_unique",
    "cleaning_loss",
    "counted_loss",
    "dedup",
    "dedup_loss",
    "dedup_rare",
    "dense_key_by_range",
    "dense_key_small",
    "distinct_values",
    "doubles_to_int",
    "drop_columns",
    "drop_missing",
    "drop_sparse",
    "dropna_loss",
    "exact_average",
    "fits_broadcast",
    "key_counts",
    "keep_one",
    "lookup_join",
    "measured_bytes",
    "merge_dimension",
    "null_percent",
    "null_profile",
    "preview",
    "raise_on_failure",
    "rename_columns",
    "row_counts",
    "select_columns",
    "sparse_columns",
]
