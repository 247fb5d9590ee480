"""Metric plans: pure functions of a Warehouse and an AsOf."""
