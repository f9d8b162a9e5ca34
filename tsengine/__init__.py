"""Feature tables, quality checks and multi-horizon forecasts for many regular time series on Spark."""
