"""lexmill: text-corpus quality analytics on Spark DataFrames."""
