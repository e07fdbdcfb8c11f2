"""Rental-market analytics and text-signal operators on PySpark DataFrames."""
