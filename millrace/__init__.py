"""Analytic operators as Spark DataFrame transformations.

Every operator takes DataFrames and returns a DataFrame; the work is
expressed with the DataFrame API so that Catalyst plans it and executors
run it.
"""
