"""Chat-corpus curation as Spark jobs."""
