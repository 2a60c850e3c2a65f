"""Logical-plan helpers: join strategy, pruning predicates, pipelines."""
