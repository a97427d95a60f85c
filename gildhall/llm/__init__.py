"""Operators for training-data pipelines.

Each module holds one operator with a general interface over DataFrames;
``queries`` registers the thin driver queries that apply them to the shared
tables. Nothing outside this subpackage imports it.
"""
