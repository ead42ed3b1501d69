"""Route-graph queries and delay classification on PySpark DataFrames."""
