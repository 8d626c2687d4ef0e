"""Order-delivery analytics as plain Spark DataFrame operators."""
