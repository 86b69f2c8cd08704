"""Operators of a training-data pipeline.

Each module holds one operator with a general interface (DataFrame in,
DataFrame out, column names as parameters).  ``queries`` applies them to the
supplied tables with production parameters.  Nothing outside this package
imports it.
"""
