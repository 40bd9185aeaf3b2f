"""Readers: CSV batches, tables, file listings, and the sales view over the star schema."""
