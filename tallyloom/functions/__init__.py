from tallyloom.functions.columns import (
    PAIR_TEXT_FORMAT,
    WORD_SEPARATOR,
    pair_text,
    parse_int_strict,
    parse_int_tolerant,
    split_lines,
    split_words,
    suffix_branch_predicate,
    suffix_tag,
)
from tallyloom.functions.rows import map_outputs, map_rows, output, outputs_schema

__all__ = [
    "PAIR_TEXT_FORMAT",
    "WORD_SEPARATOR",
    "map_outputs",
    "map_rows",
    "output",
    "outputs_schema",
    "pair_text",
    "parse_int_strict",
    "parse_int_tolerant",
    "split_lines",
    "split_words",
    "suffix_branch_predicate",
    "suffix_tag",
]
