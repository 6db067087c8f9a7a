"""Asterline: operational tables and their change feeds turned into a star with full history, on Spark."""

__all__ = ["contracts", "session"]
