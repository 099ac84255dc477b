"""Retail analytics as plain Spark DataFrame operators.

Operators take DataFrames and return DataFrames. Dates that depend on "today"
are always passed in as ``as_of``. Money stays in exact decimals until a caller
casts it.
"""

__version__ = "0.1.0"
