"""Scatter/gather work on nested tables, written for Spark DataFrames.

Arrays become long tables ``(parent keys, seq, value)``; scatter is a row per item,
gather the ordered inverse, taken at the end.  Operators take and return DataFrames or
Columns and leave strategy to the optimizer.
"""
