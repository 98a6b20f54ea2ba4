"""Payment-transaction analytics on PySpark."""
