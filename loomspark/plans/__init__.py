"""Queries, their SQL for comparison, and the staged pipeline."""
