"""Move tables into a lake with Spark and prove that the copy is right."""

__version__ = "0.1.0"
