"""Operators over parsed rows: grouping, merging, lookups, predicates, sinks."""
