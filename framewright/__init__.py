"""Tabular analytics and machine-learning operators on PySpark DataFrames."""
