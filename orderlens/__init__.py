"""Retail order analytics as Spark DataFrame transformations."""
