"""Operators on any DataFrame: duplicates, value profiles, missing values, misfiled values, and the skew-safe join."""

from starledger.operators.duplicates import duplicate_report, keep_first, remove_duplicates
from starledger.operators.joins import BROADCAST_LIMIT, FILTER_BITS, ROWS_PER_SPLIT, may_match, measured_bytes, split_join
from starledger.operators.misfiled import (
    LEAKED_TITLE,
    drop_matching,
    drop_value,
    matching_report,
    only_matching,
    value_report,
)
from starledger.operators.missing import drop_incomplete, null_drop_report, null_ratios
from starledger.operators.observed import store_clean
from starledger.operators.profiles import distinct_values, unique_value_counts, unique_values
from starledger.operators.sketches import (
    counts_of_sketches,
    merge_sketches,
    relative_error,
    unique_value_counts_approx,
    value_sketches,
)

__all__ = [
    "BROADCAST_LIMIT",
    "FILTER_BITS",
    "LEAKED_TITLE",
    "ROWS_PER_SPLIT",
    "counts_of_sketches",
    "distinct_values",
    "drop_incomplete",
    "drop_matching",
    "drop_value",
    "duplicate_report",
    "keep_first",
    "matching_report",
    "may_match",
    "measured_bytes",
    "merge_sketches",
    "null_drop_report",
    "null_ratios",
    "only_matching",
    "relative_error",
    "remove_duplicates",
    "split_join",
    "store_clean",
    "unique_value_counts",
    "unique_value_counts_approx",
    "unique_values",
    "value_report",
    "value_sketches",
]
