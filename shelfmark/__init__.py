"""Dataset-catalog analytics as Spark DataFrame operators."""
