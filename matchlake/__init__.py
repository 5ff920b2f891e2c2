"""Two-way text matching and retrieval evaluation as Spark DataFrame jobs."""
