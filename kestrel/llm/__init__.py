"""Operators for large training-data pipelines, one module each.

The rest of the library does not import this package; ``__spark_entry__`` adds its queries
when it is there. Every operator reads whole tables and whole texts, keeps its own general
interface and returns a DataFrame.
"""
