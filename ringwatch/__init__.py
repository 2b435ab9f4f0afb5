"""Call-risk analytics as Spark DataFrame operators and ML jobs."""
