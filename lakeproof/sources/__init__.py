"""Readers. Each returns a DataFrame and leaves parallelism to Spark."""
