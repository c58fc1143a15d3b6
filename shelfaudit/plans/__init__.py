"""Composite pipelines: what a report user calls."""
