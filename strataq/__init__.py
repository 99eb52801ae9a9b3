"""strataq: Spark-native analytics over versioned, tree-structured document corpora.

Everything is declared with DataFrames; the subpackage ``llm`` holds the text
operators for training data and is imported by nothing else in the library.
"""
