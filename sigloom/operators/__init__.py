"""Dataflow operators: DataFrames in, DataFrames out, nothing collected.

Order is explicit (an ordinal column) wherever "first wins" matters, and ``now`` is a parameter.
"""
