"""The registered queries, their inputs, and the same results in plain SQL."""
