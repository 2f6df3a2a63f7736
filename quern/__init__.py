"""Text-corpus preparation and recognition-quality evaluation on Spark DataFrames."""
