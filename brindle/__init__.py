"""Analytics of paired experiments, capture geometry and training text on Spark DataFrames."""
