"""Market-data analytics as PySpark DataFrame functions."""
