"""Song-play analytics on Spark: typed sources, cleaning, keyed loads, star schema, query tables, checks."""
