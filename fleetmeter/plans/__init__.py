"""The registered queries, their inputs, and SQL that states the same results."""
