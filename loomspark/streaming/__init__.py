"""Streaming sources."""
