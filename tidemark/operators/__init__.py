"""Reusable relational operators: currency joins, rank-1 per key, folds, closures, optional filters."""
