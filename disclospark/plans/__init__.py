"""Query catalogue: Spark queries and the SQL they are checked against."""
