"""Labelled-retrieval data engine on Spark: DataFrame in, DataFrame out."""
__version__ = "0.1.0"
