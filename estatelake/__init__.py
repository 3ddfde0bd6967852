"""Listings and price analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; Spark plans and runs
the work.  Only model fitting returns fitted objects.
"""
