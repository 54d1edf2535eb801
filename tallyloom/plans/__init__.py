from tallyloom.plans.jobs import (
    catalog_first_column,
    int_parse_stream_job,
    int_stream_job,
    jdbc_round_trip,
    line_branch_steps,
    line_branch_steps_stream,
    line_branches,
    line_branches_written,
    line_routing,
    name_counts,
    outputs_written,
    parse_messages,
    read_stream_branch,
    windowed_int_sums,
    word_cogroup,
    word_count,
    word_count_job,
    word_count_stream_job,
    word_count_text,
)

__all__ = [
    "catalog_first_column",
    "int_parse_stream_job",
    "int_stream_job",
    "jdbc_round_trip",
    "line_branch_steps",
    "line_branch_steps_stream",
    "line_branches",
    "line_branches_written",
    "line_routing",
    "name_counts",
    "outputs_written",
    "parse_messages",
    "read_stream_branch",
    "windowed_int_sums",
    "word_cogroup",
    "word_count",
    "word_count_job",
    "word_count_stream_job",
    "word_count_text",
]
