"""Operators for preparing language-model training data, on Spark.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when it can be imported.
"""
