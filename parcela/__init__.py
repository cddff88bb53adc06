"""Property-listing analytics on PySpark."""
