"""Registered queries over the given tables, and the logs Spark derives from them."""
