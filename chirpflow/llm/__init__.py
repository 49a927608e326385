"""Operators for training-data preparation: packing, search, quality, language,
personal data, near duplicates, tokenization and archives.

Nothing else in the library imports this subpackage.  Every operator is a
function from DataFrames to a DataFrame; Spark partitions, shuffles and stores
the data, and the Python inside a task works on one bounded Arrow batch.
"""
