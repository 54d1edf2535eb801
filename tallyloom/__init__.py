"""tallyloom: keyed counting, grouping, routing and windowed sums as Spark jobs.

Layout:
  functions/  column expressions and the per-batch user-function hook
  operators/  DataFrame -> DataFrame operators (projections, filters, routing,
              aggregates, bounded group / co-group)
  sources/    literal rows, text files, JDBC, catalog tables, Kafka, file streams
  sinks/      text files, JDBC, one-pass branch output, taps
  streaming/  tumbling-window sums and an idempotent update sink
  plans/      the composed jobs and the registry of checked queries
"""

__version__ = "0.1.0"
