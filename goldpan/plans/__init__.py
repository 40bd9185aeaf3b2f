"""Whole runs: landing batches, refreshing Silver and Gold."""
