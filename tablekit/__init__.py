"""A table and analytics layer on PySpark."""
