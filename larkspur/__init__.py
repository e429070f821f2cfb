"""Larkspur: social-graph snapshot analytics as plain Spark DataFrames."""
