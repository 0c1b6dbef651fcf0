"""entlens: entity-conditioned text analytics on Spark DataFrames."""
