"""DataFrame operators of record linkage."""
