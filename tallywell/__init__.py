"""Transaction-quality lakehouse operators as PySpark DataFrame functions."""
