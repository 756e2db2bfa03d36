"""Named plans over the operators: pipeline, metrics, quality checks and reports."""
