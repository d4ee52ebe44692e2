"""Row-set operators: predicates, chunks, merges, comparison, integrity, statistics."""
