"""Market-data frames as Spark tables and streams."""
