"""Genomic and quality-control tables on PySpark: operators are functions from DataFrames to DataFrames."""
