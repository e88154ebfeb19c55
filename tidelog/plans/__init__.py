"""Jobs: whole pipelines from inputs to written tables."""
