"""Text-classification data engine on Spark DataFrames."""
