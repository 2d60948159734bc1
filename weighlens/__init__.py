"""Recognition-quality reports and training-set selection as Spark jobs."""
