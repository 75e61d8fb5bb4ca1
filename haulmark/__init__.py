"""Vehicle telemetry, delivery and incident analytics on Spark DataFrames."""
