"""siftlane: two-stage retrieval and context reduction as Spark DataFrame jobs."""

__version__ = "0.1.0"
