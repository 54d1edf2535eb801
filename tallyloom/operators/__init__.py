from tallyloom.operators.aggregates import count_per_element, sum_all, sum_per_key
from tallyloom.operators.grouping import DEFAULT_CHUNK_SIZE, cogroup, cogroup_stored, fold_repeats, fold_sum, group_values
from tallyloom.operators.routing import branch_tags, branches, route
from tallyloom.operators.transforms import (
    key_ones,
    key_value,
    lines,
    nth_column,
    not_null,
    pair_text,
    parse_int,
    parse_int_rejects,
    scale,
    text_words,
    words,
)

__all__ = [
    "DEFAULT_CHUNK_SIZE",
    "branch_tags",
    "branches",
    "cogroup",
    "cogroup_stored",
    "count_per_element",
    "fold_repeats",
    "fold_sum",
    "fold_sum",
    "group_values",
    "key_ones",
    "key_value",
    "lines",
    "not_null",
    "nth_column",
    "pair_text",
    "parse_int",
    "parse_int_rejects",
    "route",
    "scale",
    "sum_all",
    "sum_per_key",
    "text_words",
    "words",
]
