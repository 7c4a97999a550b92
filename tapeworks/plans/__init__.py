"""Registered queries, the inputs they derive from the tables, their SQL."""
