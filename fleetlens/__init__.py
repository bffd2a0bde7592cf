"""Equipment-fleet analytics as plain Spark DataFrame and Column functions."""

__version__ = "0.1.0"
