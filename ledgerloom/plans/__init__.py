"""Query catalogue: the callables and comparison SQL that the entry module registers."""
