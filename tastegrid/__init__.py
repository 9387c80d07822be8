"""tastegrid: user-item rating analytics written as Spark DataFrame jobs."""
