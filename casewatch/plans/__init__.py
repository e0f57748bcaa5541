"""Model plans: staging, dimensions, fact, marts, quality checks, measures, ingest."""
