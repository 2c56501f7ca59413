"""Incremental processing of arriving days."""
