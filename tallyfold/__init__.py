"""Cumulative, dimensional and fact-modelling operators on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame built from native
Spark expressions, so Catalyst plans it and whole-stage codegen runs it.
"""

__version__ = "0.1.0"

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
