"""millrace: bronze / silver / gold table building as plain functions on Spark DataFrames."""
