"""Named datasets, reports, the query catalog and the pipeline run."""
