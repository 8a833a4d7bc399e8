from starflow.operators.checks import duplicate_counts, preview, row_counts
from starflow.operators.dimensions import calendar_dimension, conformed_dimension
from starflow.operators.facts import build_fact
from starflow.operators.history import latest_per_key, merge_history
from starflow.operators.joins import lookup_join, skew_join
from starflow.operators.keys import dense_key, key_map, rekey, remap_keys
from starflow.operators.parsing import complete_schema, flatten, mark_unusable, parse_json
from starflow.operators.rules import Rule, apply_rules, flag_counts, flag_profile
from starflow.operators.uniqueness import new_rows_only, one_per_key

__all__ = [
    "Rule",
    "apply_rules",
    "build_fact",
    "calendar_dimension",
    "complete_schema",
    "conformed_dimension",
    "dense_key",
    "duplicate_counts",
    "flag_counts",
    "flag_profile",
    "flatten",
    "key_map",
    "latest_per_key",
    "lookup_join",
    "mark_unusable",
    "merge_history",
    "new_rows_only",
    "one_per_key",
    "parse_json",
    "preview",
    "rekey",
    "remap_keys",
    "row_counts",
    "skew_join",
]
