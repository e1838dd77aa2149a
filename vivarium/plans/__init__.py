"""The registered queries, with their SQL, over the given tables."""
