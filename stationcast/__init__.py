"""Station-level demand analytics and text sentiment as plain Spark DataFrame operators."""
