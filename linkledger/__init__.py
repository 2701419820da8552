"""Record linkage and contact data quality analytics on Spark DataFrames."""
