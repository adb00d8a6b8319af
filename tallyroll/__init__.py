"""Coupon receipt analytics on PySpark.

Every operator is a plain function from DataFrames to a DataFrame; nothing here
runs a Python function on rows.
"""
