"""Document-retrieval analytics on Spark: every operator is DataFrame -> DataFrame."""
