"""Fixed values.

These must equal the behaviour of the programs this library re-expresses;
changing one changes results.  Listed in the order the programs use them.
"""

# Word splitting: exactly one ASCII space separates words (tabs do not).
WORD_SEPARATOR = " "

# Text of a counted word: "KV{<word>, <count>}".
PAIR_TEXT_FORMAT = "KV{%s, %d}"

# Line routing: a line ending in "world" goes to output "world", else one
# ending in "spark" to output "spark", else to the default output "flink".
ROUTING_RULES = [("world", "world"), ("spark", "spark")]
ROUTING_DEFAULT = "flink"

# Text-file lines end at "\r\n", "\r" or "\n".
LINE_SEPARATOR_PATTERN = "\r\n|\r|\n"

# Database job: each name's row count is multiplied by 10.
JDBC_FACTOR = 10

# Stream job: tumbling windows of 5 seconds.
WINDOW_DURATION = "5 seconds"
