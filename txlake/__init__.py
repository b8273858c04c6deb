"""txlake: a payments lakehouse written as Spark DataFrame jobs."""
