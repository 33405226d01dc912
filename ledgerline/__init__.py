"""Evidence analytics, hybrid retrieval and data-quality operators on Spark DataFrames."""
