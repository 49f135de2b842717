"""gridspark: electricity-demand and weather time series on Spark DataFrames."""
