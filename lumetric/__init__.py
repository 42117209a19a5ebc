"""Creative analytics as Spark DataFrame transforms."""
