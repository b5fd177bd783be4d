"""DataFrame operators that Spark does not have built in, composed from joins, grouping and windows."""
