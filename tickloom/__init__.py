"""tickloom: market-data quality and causal-event analytics on Spark."""
