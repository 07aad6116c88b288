"""Training-data operators: filters, deduplication, tokenisation, packing.

Nothing else in the library imports this subpackage, and every module in it
works on plain DataFrames.  ``queries`` registers one thin query per operator.
"""
