"""Tallyhouse: sales, loyalty, order-cleaning and rollup jobs on PySpark DataFrames."""
