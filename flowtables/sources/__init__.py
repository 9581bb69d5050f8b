"""Readers: change logs, change tables, topics, framed bytes, tables by id."""
