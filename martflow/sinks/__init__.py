"""Writing: dispositions, day partitions, clustered layouts, checks and models."""
