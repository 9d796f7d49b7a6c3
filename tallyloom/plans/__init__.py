"""The registered queries: the operators over the given tables, and equivalent SQL."""
