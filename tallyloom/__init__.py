"""Tallyloom: table, text, image, learning and stream operators for PySpark.

Every operator takes DataFrames (or Columns) and returns DataFrames (or Columns).
"""

__version__ = "0.1.0"
