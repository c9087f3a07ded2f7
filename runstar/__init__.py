"""Nested record feeds to a run-partitioned star schema, as Spark jobs."""
