"""Spark jobs over a large scholarly corpus kept as date-partitioned parquet."""
