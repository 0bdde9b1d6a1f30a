"""Incremental collection, ranking and data-quality operators for Spark.

Every operator takes DataFrames and returns a DataFrame; ``as_of`` stands in
for the wall clock wherever a rule depends on the current time.
"""
