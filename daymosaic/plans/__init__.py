"""Whole pipelines, each one lazy plan over all dates and provinces."""
