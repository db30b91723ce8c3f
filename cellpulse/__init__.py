"""Mobile-network activity analytics as plain Spark DataFrame functions."""
