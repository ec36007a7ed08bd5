"""The registered queries: matrices taken from the given tables, and what is asked of them."""
