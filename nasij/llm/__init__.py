"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general interface; ``registry`` derives
the registered queries and their SQL from them. Nothing outside this
subpackage imports it.
"""
