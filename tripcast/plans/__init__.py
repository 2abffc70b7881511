"""Composed plans: the batch build, the registered query set, bench entry points."""
