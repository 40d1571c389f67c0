"""Retail sales and web-shop event analytics as plain Spark DataFrame operators."""
