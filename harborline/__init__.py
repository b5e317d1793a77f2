"""harborline: port and shipping analytics as Spark DataFrame jobs."""
