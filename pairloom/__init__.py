"""pairloom: Spark-first curation of web image/caption pairs and text corpora.

Every operator is a function from DataFrames to DataFrames.  Nothing here starts
a session, reads the wall clock or needs a network.
"""

__version__ = "0.1.0"
