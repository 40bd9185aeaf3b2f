"""Layer transformations, quality checks, reports, sinks and test batches."""
