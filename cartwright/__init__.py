"""Retail basket analytics and hybrid recommendation on Spark DataFrames."""
