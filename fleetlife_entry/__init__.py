"""The queries behind __spark_entry__.py and their SQL counterparts."""
