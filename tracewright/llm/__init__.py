"""Operators for building language-model training data.

Every operator module holds a general function on DataFrames, the thin
``opN_<name>(spark, sf_dir)`` query over the whole table, and its SQL where SQL
can express the result.  ``registry`` lists them all.
"""
