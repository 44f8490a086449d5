"""Incident analytics on Spark: batch reports and streaming transformations.

Every operator is a function from DataFrame to DataFrame. Operators never start
a Spark action; only ``plans``, ``sinks`` and ``streaming`` do.
"""
