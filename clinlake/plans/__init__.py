"""Named datasets: Silver, Gold, ingestion steps and the pipeline."""
