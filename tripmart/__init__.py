"""Layered star-schema building, checking and reporting on Spark DataFrames."""
