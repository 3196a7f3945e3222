"""Layered (bronze, silver, gold) analytics as plain functions on Spark DataFrames."""
