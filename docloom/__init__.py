"""Document and query engine on PySpark."""
