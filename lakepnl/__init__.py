"""Layered trade and price reporting on Spark DataFrames."""
