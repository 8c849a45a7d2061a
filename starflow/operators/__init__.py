"""Reusable DataFrame operators (inventory U1, W1, F6, A2-A8, J1-J10, O3, V1-V12)."""

from .aggregates import explode_lookup_collect, lookup_list, trailing_years, weekly_mean
from .joins import lookup, lookup_default, small_side
from .quality import (CheckResult, Expectation, check_table, duplicate_keys, enforce, key_parts, orphan_keys,
                      profile, schema_problems)
from .relational import distinct_values, first_per_group, top_k_counts, union_all

__all__ = [
    "explode_lookup_collect", "lookup_list", "trailing_years", "weekly_mean",
    "lookup", "lookup_default", "small_side",
    "CheckResult", "Expectation", "check_table", "duplicate_keys", "enforce", "key_parts", "orphan_keys",
    "profile", "schema_problems",
    "distinct_values", "first_per_group", "top_k_counts", "union_all",
]
