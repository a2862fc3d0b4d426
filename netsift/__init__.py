"""Network reconnaissance data on Spark."""
