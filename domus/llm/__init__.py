"""Operators for large-scale training-data pipelines (one module each).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""
