"""Key=value event logs as a star schema on Spark."""
