"""Table-to-table jobs and the derivation of their inputs from given tables."""
