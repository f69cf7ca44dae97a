"""Operators: DataFrame in, DataFrame out.

Look-ups take the control tables and, optionally, a DataFrame of requested keys. Without keys they answer for all keys.
"""
