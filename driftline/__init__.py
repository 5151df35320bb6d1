"""driftline: moored-instrument time series on Spark DataFrames."""
