"""Land-cover mapping as Spark DataFrame jobs."""
