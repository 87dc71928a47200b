"""Population, health and mobility statistics on Spark DataFrames."""
