"""Merchant traffic analytics as Spark DataFrame plans.

Every plan takes DataFrames and returns a lazy DataFrame; the caller decides when and where to run it.
"""
