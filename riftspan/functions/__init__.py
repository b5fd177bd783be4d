"""Column-level building blocks. Nothing in this package triggers a job or uses a Python UDF."""
