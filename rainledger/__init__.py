"""Set-based district water-status analytics on PySpark."""
