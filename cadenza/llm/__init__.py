"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it.  Each module holds one operator as
functions from DataFrames to DataFrames; ``queries`` registers them.
"""
