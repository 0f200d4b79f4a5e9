"""Composed jobs and the helpers that cut their lineage."""
