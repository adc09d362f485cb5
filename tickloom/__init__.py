"""Daily price time-series as Spark jobs: ingest, upkeep, checks, indicators."""
