"""The train-movement stream."""
