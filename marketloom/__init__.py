"""Market time-series analytics on Spark: bronze, silver and gold as DataFrame operators."""
